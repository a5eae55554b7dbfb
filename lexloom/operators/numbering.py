"""Running numbers without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def number_rows(df: DataFrame, order: list[str], out: str = "ordinal", start: int = 1, parts: int | None = None) -> DataFrame:
    """``df`` with a dense number by ``order``. Ties get numbers in no set order, so order by a key.

    Rows are range-partitioned and numbered within their partition; partition sizes,
    one row each, shift them. Nulls come first.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return placed.withColumn("_r", local).join(F.broadcast(before), "_part").withColumn(out, (F.col("_r") + F.col("_before") + (start - 1)).cast("long")).drop("_part", "_r", "_before")


def first_seen(df: DataFrame, keys: list[str], order: str, out: str = "seen_no") -> DataFrame:
    """Distinct keys numbered by first appearance."""
    return number_rows(df.groupBy(*keys).agg(F.min(order).alias("first_at")), ["first_at", *keys], out)


def number_within(df: DataFrame, group: list[str], order: list[str], out: str = "n") -> DataFrame:
    """``df`` with a dense number from 1 within each group, however large the groups: the running number less the group's first. Null groups are left out."""
    numbered = number_rows(df, [*group, *order], "_o")
    first = numbered.groupBy(*group).agg(F.min("_o").alias("_f"))
    return numbered.join(first, group).withColumn(out, F.col("_o") - F.col("_f") + 1).drop("_o", "_f")


def next_ids(current: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``new`` with ids that go on from the largest ``key`` of ``current``."""
    top = current.agg(F.max(key)).first()[0] or 0
    return number_rows(new, order, key, start=top + 1)
