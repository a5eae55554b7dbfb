"""The version of a key that counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_version(df: DataFrame, key: str, version: str, *columns: str) -> DataFrame:
    """``key``, ``version`` and ``columns`` of each key's row with the largest ``version``.

    Of rows that tie, the one with the largest columns, so repeated rows give one.
    Null versions lose to any other. Null keys form no row. A partial aggregate,
    so that a key with many versions is reduced before the shuffle.
    """
    rest = [F.col(c) for c in columns]
    best = F.max(F.struct(F.col(version).alias(version), *rest))
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(best.alias("_v")).select(key, "_v.*")
