"""Scoring and tracking of arriving rows; violation rate over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from modsieve.operators.model import score
from modsieve.sources.tables import tracking_rows


def append_stream(df: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = (), once: bool = True) -> StreamingQuery:
    """Exactly-once file sink; ``once`` processes what is there and stops."""
    writer = df.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (writer.trigger(availableNow=True) if once else writer).start()


def update_stream(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Store the rows that each batch changes, in a folder of that batch; a repeated batch replaces its own."""

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = df.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    """The newest state of every key that ``update_stream`` has stored."""
    rows = spark.read.parquet(path)
    names = [c for c in rows.columns if c not in (*key, "batch")]
    newest = rows.groupBy(*key).agg(F.max_by(F.struct(*names), "batch").alias("r"))
    return newest.select(*key, "r.*")


def stream_score_and_track(stream: DataFrame, model: PipelineModel, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Score arriving rows and append (id, body, violation, timestamp) to the tracking table."""
    rows = tracking_rows(score(model, stream), F.current_timestamp(), "prediction")
    return append_stream(rows, path, checkpoint, ("day",), once)


def violation_rate(tracked: DataFrame, window: str = "1 hour", delay: str = "10 minutes", threshold: float = 0.5) -> DataFrame:
    """Rows, mean score and share of violations per window; on a stream, rows later than ``delay`` are dropped."""
    return (
        tracked.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", window))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.round(F.avg("violation"), 6).alias("mean_violation"),
            F.round(F.avg((F.col("violation") > threshold).cast("int")), 6).alias("violation_rate"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n_rows", "mean_violation", "violation_rate")
    )
