"""Incremental export of circuits: a keyed, idempotent append instead of a growing checkpoint file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def add_batch(batch: DataFrame, table: str, epoch: int) -> None:
    """Write one batch under its number; written again after a failure, it takes its own place."""
    batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{table}/epoch={epoch:09d}")


def collected(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """All circuits so far, the last of each filename."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(table)
    columns = [c for c in rows.columns if c not in ("epoch", "filename")]
    return rows.groupBy("filename").agg(F.max_by(F.struct(*columns), "epoch").alias("c")).select("filename", "c.*")


def run_incrementally(circuits: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Export a stream of circuits as far as it has come; started again, it goes on from its checkpoint."""
    writer = circuits.writeStream.foreachBatch(lambda batch, epoch: add_batch(batch, table, epoch))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
