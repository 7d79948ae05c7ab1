"""Reading and writing tables: typed sources, stages, reports, tracked predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modsieve.sources.csv_ranges import read_ranges
from modsieve.spec import COLUMNS, TableSpec


def read_csv(
    spark: SparkSession, path: str, spec: TableSpec | None = None, multi_line: bool = True, ranges: bool = True, file: str | None = None
) -> DataFrame:
    """A CSV table by the names in its header, whatever their order.

    Declared columns that the file lacks stay absent, so the layout check reports them. A
    column gets its declared type if every value fits; otherwise it stays text, and the type
    check counts the values that do not fit. One pass over the file decides that for all
    columns. ``multi_line`` allows line breaks inside quotes; with ``ranges`` many tasks read one
    file all the same (see ``csv_ranges``, which wants well-formed quotes), without it each file is one
    task. ``file`` adds the file's name under that name.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    raw = reader.csv(path)
    named = [file] if file else []
    if multi_line and ranges:
        raw = read_ranges(spark, path, raw.columns, file)
    elif file:
        raw = raw.select("*", F.col("_metadata.file_name").alias(file))
    if spec is None:
        return raw
    types = {f.name: f.dataType for f in spec.schema.fields}
    declared = [c for c in spec.columns if c in raw.columns]
    typed = [c for c in declared if not isinstance(types[c], T.StringType)]
    fits: set[str] = set()
    if typed:
        bad = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(types[c]).isNull()).alias(c) for c in typed]
        found = raw.agg(*bad).first()  # one row of counts
        fits = {c for c in typed if found[c] == 0}
    kept = [c for c in raw.columns if c in declared or c in named]
    return raw.select(*[F.col(c).cast(types[c]).alias(c) if c in fits else F.col(c) for c in kept])


def read_sources(
    spark: SparkSession,
    paths: Mapping[str, str],
    specs: Mapping[str, TableSpec] | None = None,
    with_file: bool = False,
    multi_line: bool = True,
    ranges: bool = True,
) -> dict[str, DataFrame]:
    """One table per named file or directory, CSV or Parquet by the path's ending.

    Only declared columns are kept, in the table's own order; see ``read_csv`` for what
    happens when a CSV file does not fit. ``with_file`` adds the source ``file``.
    """
    tables = {}
    for name, path in paths.items():
        spec = (specs or {}).get(name)
        if ".parquet" in path:
            df = spark.read.parquet(path)
            declared = [c for c in spec.columns if c in df.columns] if spec else df.columns
            extra = [F.col("_metadata.file_name").alias("file")] if with_file else []
            tables[name] = df.select(*declared, *extra)
        else:
            tables[name] = read_csv(spark, path, spec, multi_line, ranges, "file" if with_file else None)
    return tables


def file_role(name: Column) -> Column:
    """Roles of a file by its name: it may be both test and submission; neither means train."""
    test, submission = name.contains("test"), name.contains("sub")
    roles = F.array(F.when(test, "test"), F.when(submission, "submission"), F.when(~test & ~submission, "train"))
    return F.array_compact(roles)


def stage_path(root: str, stages: Sequence[str] | str, dataset: str) -> str:
    """Folder of a stage: the stages that ran, then the dataset."""
    names = [stages] if isinstance(stages, str) else list(stages)
    return f"{root.rstrip('/')}/{'_'.join([*names, dataset])}"


def write_stage(
    df: DataFrame, root: str, stages: Sequence[str] | str, dataset: str, format: str = "parquet", partition_by: Sequence[str] = ()
) -> str:
    """Persist a stage and return its folder."""
    path = stage_path(root, stages, dataset)
    writer = df.write.mode("overwrite").format(format).partitionBy(*partition_by)
    if format == "csv":
        writer = writer.option("header", True).option("escape", '"')
    elif format == "parquet":
        writer = writer.option("compression", "zstd")  # texts are most of it
    writer.save(path)
    return path


def write_report(report: DataFrame, path: str) -> str:
    report.write.mode("overwrite").json(path)
    return path


def tracking_rows(df: DataFrame, ts: Column, score: str, body: str = COLUMNS.body, key: str = COLUMNS.key) -> DataFrame:
    """Rows of the tracking table: id, body, violation, timestamp, and the day it is stored under."""
    return df.select(
        F.col(key).alias("id"),
        F.col(body).alias("body"),
        F.col(score).cast("double").alias("violation"),
        ts.alias("timestamp"),
        F.to_date(ts).alias("day"),
    )


def track_predictions(df: DataFrame, path: str, ts: Column, score: str = COLUMNS.label, run: str | None = None, **names) -> str:
    """Add predictions to the tracking table, stored by day, and by ``run`` if one is named.

    A named run replaces what the same run stored for the same days, so a run that is tried
    again leaves one copy; other runs stay. Without a name the rows are appended.
    """
    rows = tracking_rows(df, ts, score, **names)
    if run is None:
        rows.write.mode("append").partitionBy("day").parquet(path)
    else:
        rows = rows.withColumn("run", F.lit(run))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "run").parquet(path)
    return path


def insert_predictions(
    df: DataFrame, url: str, table: str, ts: Column, score: str = COLUMNS.label, properties: Mapping[str, str] | None = None, **names
) -> None:
    """The same rows into a database table, which numbers them itself."""
    rows = tracking_rows(df, ts, score, **names).select("body", "violation", "timestamp")
    rows.write.jdbc(url, table, mode="append", properties=dict(properties or {}))


def conform_union(
    tables: Sequence[DataFrame], specs: Sequence[TableSpec], with_fold: bool = False
) -> DataFrame:
    """Features, target and optionally fold of every table that has them all, stacked."""
    stacked = None
    for df, spec in zip(tables, specs):
        wanted = list(dict.fromkeys([*spec.features, spec.target, *(["fold"] if with_fold else [])]))
        if any(c not in df.columns for c in wanted):
            continue
        part = df.select(*wanted)
        stacked = part if stacked is None else stacked.unionByName(part)
    if stacked is None:
        raise ValueError("no table has all the wanted columns")
    return stacked
