"""References to records that do not exist.

A Bloom filter over all parent keys, sent to every task, proves that a key was
never seen: such references are orphans without any join. Only the others are
verified by an exact join, which also tells parents that came later or were
deleted before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .bloom import Bloom


def parents(rows: DataFrame, key: Column, loaded: Column, deleted: Column | None = None) -> DataFrame:
    """One row per parent key with its first load and first deletion."""
    gone = F.lit(None).cast("timestamp_ntz") if deleted is None else deleted
    return (
        rows.select(key.cast("string").alias("pkey"), loaded.alias("p_loaded"), gone.alias("p_deleted"))
        .filter(F.col("pkey").isNotNull())
        .groupBy("pkey")
        .agg(F.min("p_loaded").alias("p_loaded"), F.min("p_deleted").alias("p_deleted"))
    )


def find_orphans(refs: DataFrame, parent_rows: DataFrame, key: str, at: str) -> DataFrame:
    """The rows of ``refs`` whose ``key`` has no target at time ``at``, with ``orphan_kind``.

    ``parent_rows`` has pkey, p_loaded, p_deleted (see ``parents``). Kinds:
    ``missing``, the key never occurs; ``late``, its first load is after the
    reference's; ``deleted``, a deletion is at or before it. The first that holds
    is given. A null key is no reference. A null time, on either side, is neither
    late nor deleted. Repeated references stay repeated. Empty parents make every
    reference missing; empty references give an empty result. ``refs`` keeps all
    its columns; pkey, p_loaded and p_deleted are reserved names.

    Orphans that the filter proves take no part in the join. References are not
    grouped by key at any point before it, and it is left to the planner: a small
    parent side is broadcast by its measured size, a large one is shuffled, where
    adaptive execution splits hot keys.
    """
    known = stage(parent_rows, "parents")
    bloom = Bloom(known, "pkey")
    real = refs.filter(F.col(key).isNotNull()).withColumn(key, F.col(key).cast("string"))
    tested = stage(real.withColumn("_seen", bloom.might_contain(key)), "tested")
    joined = tested.filter("_seen").join(known, F.col(key) == F.col("pkey"), "left")
    kind = (
        F.when(F.col("pkey").isNull(), "missing")
        .when(F.col("p_loaded") > F.col(at), "late")
        .when(F.col("p_deleted") <= F.col(at), "deleted")
    )
    verified = joined.withColumn("orphan_kind", kind).filter(F.col("orphan_kind").isNotNull()).drop("_seen", "pkey", "p_loaded", "p_deleted")
    return verified.unionByName(tested.filter("NOT _seen").drop("_seen").withColumn("orphan_kind", F.lit("missing")))


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans per table, month and kind; pre-aggregated before the shuffle."""
    return orphans.groupBy("tbl", "ref_month", "orphan_kind").agg(F.count("*").alias("n_orphans"))
