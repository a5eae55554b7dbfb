"""The incremental form of a batch step: what is new since the last run, once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_root


def run_available(spark: SparkSession, source: str, schema, step: Callable[[DataFrame, int], None], checkpoint: str, pattern: str = "*.parquet") -> None:
    """Feed all unseen files of a directory through ``step``, batch by batch, and stop.

    The checkpoint remembers what was processed, so that a second run sees only
    new files; ``step`` gets the batch number to make its writes idempotent.
    """
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(source)
    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def daily_counts(spark: SparkSession, source: str, schema, pattern: str, run: str) -> DataFrame:
    """Events per day and type from a file stream, each batch written under its number, then summed."""
    out, check = (f"{scratch_root(spark)}/{run}-{x}" for x in ("counts", "checkpoint"))

    def step(batch: DataFrame, number: int) -> None:
        per = batch.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
        per.write.mode("overwrite").parquet(f"{out}/batch={number}")

    run_available(spark, source, schema, step, check, pattern)
    return spark.read.parquet(out).groupBy("day", "event_type").agg(F.sum("n").alias("n_events"))
