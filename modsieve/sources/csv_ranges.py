"""CSV files with line breaks inside quotes, read in byte ranges by many tasks.

A line break ends a record if the quotes before it are even in number. So each byte range of
a file counts its quotes; running parities over the ranges of a file tell which ranges begin
inside quotes; then every range cuts its records by itself. Records that cross a range's edge
are cut into pieces, which are few, and stitched by their order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modsieve.session import cut_lineage

WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3
# Fixed value: a task reads ranges of this many bytes in all, if that leaves tasks for all cores.
TASK_BYTES = 32 << 20
# Fixed value: a record of the usual CSV form, quotes only around fields or doubled inside.
_FIELD = r'(?:[^",]*|"(?:[^"]|"")*")'
RECORD = rf"(?s)\A{_FIELD}(?:,{_FIELD})*\r?\z"
SCHEMA = "file string, start long, crlf boolean, kind int, first boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines by byte range, in the file's order inside each range; small ranges share a task."""
    lines = spark.read.option("lineSep", "\n").text(path)
    splits, most = lines.rdd.getNumPartitions(), 2 * spark.sparkContext.defaultParallelism
    ranges = spark.read.format("binaryFile").load(path).select("length")  # sizes only, the files are not read
    tasks = max(most, -(-(ranges.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES))
    if tasks < splits:
        lines = lines.coalesce(tasks)
    return lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("range"),
    )


def _ranges(lines: DataFrame) -> DataFrame:
    """(file, start, range, inside): whether a range begins inside quotes; one small row per range."""
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    crlf = F.min_by(F.endswith("value", F.lit("\r")), "place")  # of the first line
    placed = lines.withColumn("place", F.monotonically_increasing_id())
    counted = cut_lineage(placed.groupBy("file", "start", "range").agg((F.sum(quotes) % 2).alias("odd"), crlf.alias("crlf")))
    open_ = counted.groupBy("file").agg((F.sum("odd") % 2).alias("odd")).where("odd = 1").limit(3).collect()
    if open_:
        raise ValueError(f"quotes are not closed in {[r.file for r in open_]}")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    marked = counted.withColumn("inside", F.coalesce(F.sum("odd").over(earlier) % 2, F.lit(0)))
    whole = Window.partitionBy("file")
    return cut_lineage(marked.withColumn("crlf", F.min_by("crlf", "start").over(whole)))


class _Cutter:
    """Cuts the lines of one range into records and pieces of records."""

    def __init__(self, file: str, start: int, inside: int, crlf: bool):
        self.file, self.start, self.crlf, self.state, self.headless = file, start, crlf, inside, inside == 1
        self.first, self.pending = start == 0, []

    def rows(self, records: pa.Array, kind: int) -> pa.RecordBatch:
        n = len(records)
        first = np.zeros(n, bool)
        if kind in (WHOLE, TAIL) and n:
            first[0], self.first = self.first, False
        columns = [
            pa.array([self.file] * n, pa.string()), pa.array(np.full(n, self.start)), pa.array(np.full(n, self.crlf)),
            pa.array(np.full(n, kind, np.int32)), pa.array(first), records,
        ]
        return pa.RecordBatch.from_arrays(columns, names=["file", "start", "crlf", "kind", "first", "record"])

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        state = (self.state + np.cumsum(quotes)) % 2
        ends, held = np.flatnonzero(state == 0), sum(map(len, self.pending))
        self.pending.append(lines)
        self.state = int(state[-1])
        if not len(ends):
            return
        lines = pa.concat_arrays(self.pending)
        offsets = pa.array(np.concatenate([[0], ends + held + 1]), pa.int32())
        records = pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")
        self.pending = [rest] if len(rest := lines.slice(int(ends[-1]) + held + 1)) else []
        if self.headless:
            self.headless = False
            yield self.rows(records.slice(0, 1), HEAD)
            records = records.slice(1)
        if len(records):
            yield self.rows(records, WHOLE)

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.pending:
            whole = pa.array(["\n".join(x for part in self.pending for x in part.to_pylist())], pa.string())
            yield self.rows(whole, MIDDLE if self.headless else TAIL)


def _cut(whole: bool):
    """Whole records of every range, or else the pieces at its edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, at = None, None

        def wanted(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in found:
                if (rows.column("kind")[0].as_py() == WHOLE) != whole:
                    continue
                if whole and not pc.all(pc.match_substring_regex(rows.column("record"), RECORD)).as_py():
                    raise ValueError(f"{cutter.file}: quotes inside an unquoted field; read it with multi_line=True")
                yield rows

        for batch in batches:
            names = batch.column("range").to_numpy()
            if not len(names):
                continue
            edges = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
            for a, b in zip(edges, edges[1:]):
                if names[a] != at:
                    if cutter:
                        yield from wanted(cutter.close())
                    at = names[a]
                    cutter = _Cutter(*(batch.column(c)[a].as_py() for c in ("file", "start", "inside", "crlf")))
                yield from wanted(cutter.add(batch.column("value").slice(a, b - a)))
        if cutter:
            yield from wanted(cutter.close())

    return run


def _stitched(pieces: DataFrame) -> DataFrame:
    """Records made of a range's end, whole ranges, and a later range's beginning."""
    order = Window.partitionBy("file").orderBy("start", F.col("kind") == TAIL)
    narrow = pieces.select("file", "start", "kind")
    # At most two narrow rows of each range; the texts are joined by the number afterwards.
    number = F.sum((F.col("kind") == TAIL).cast("int")).over(order)
    numbered = narrow.withColumn("number", number)
    both = pieces.join(numbered, ["file", "start", "kind"])
    texts = F.array_sort(F.collect_list(F.struct("start", "record")))
    joined = both.groupBy("file", "number", "crlf").agg(F.max("first").alias("first"), texts.alias("parts"))
    return joined.select("file", "crlf", "first", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))


def read_ranges(spark: SparkSession, path: str, columns: list[str], file: str | None = None) -> DataFrame:
    """All fields as text under ``columns``, as Spark's own reader gives them with ``multiLine``.

    The first record of every file is its header. Records end with LF or CRLF; line breaks inside
    quotes stay; quotes inside quotes are doubled. Quotes that are not closed by the
    end of the file, or that stand inside an unquoted field, raise an error. ``file`` adds
    the file's name.
    """
    lines = _lines(spark, path)
    ranges = _ranges(lines)
    # some 20 bytes of every range of many MB; the ranges of a second scan must be those of the first.
    marks = F.broadcast(ranges.select(F.col("range").alias("__range"), "inside", "crlf"))
    known = F.assert_true(F.col("inside").isNotNull(), "the files or their splits have changed between two scans")
    marked = lines.join(marks, F.col("range") == F.col("__range"), "left").where(known.isNull()).select("value", "file", "start", "range", "inside", "crlf")
    records = marked.mapInArrow(_cut(True), SCHEMA).select("file", "crlf", "first", "record")
    if not ranges.where("inside = 1").isEmpty():
        pieces = cut_lineage(marked.mapInArrow(_cut(False), SCHEMA))
        records = records.unionByName(_stitched(pieces))
    # As Spark's reader has it: files whose first line ends with CRLF have LF for it throughout.
    plain = F.replace(F.concat("record", F.lit("\n")), F.lit("\r\n"), F.lit("\n"))
    record = F.when(F.col("crlf"), F.left(plain, F.char_length(plain) - 1)).otherwise(F.col("record"))
    records = records.where("not first").select("file", record.alias("record")).where("record <> ''")
    names = [f"c{i}" for i in range(len(columns))]  # a header may hold any characters
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    parsed = records.select("file", F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), {"escape": '"', "multiLine": "true"}).alias("r"))
    named = [F.col(f"r.{n}").alias(c) for n, c in zip(names, columns)]
    return parsed.select(*named, *([F.element_at(F.split("file", "/"), -1).alias(file)] if file else []))
