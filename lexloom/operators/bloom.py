"""Bloom filters built by Spark and tested in Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 29  # 64 MB: the size bound of what is broadcast, whatever the number of keys
HASHES = 5
RANGE = 1 << 13  # words packed into one row, 64 kB


def _steps(h1: np.ndarray, h2: np.ndarray, bits: int):
    for i in range(HASHES):
        yield (h1 + np.uint64(i) * h2) % np.uint64(bits)


def bits_for(keys: int, per_key: int = 10) -> int:
    """A power of two of at least ``per_key`` bits a key, within MOST_BITS."""
    return min(MOST_BITS, 1 << max(10, (max(1, keys) * per_key - 1).bit_length()))


class Bloom:
    """A filter over the string keys of a frame. Null keys are never in it.

    Each task sets bits in its own array and emits only non-zero words; Spark ORs
    the words and packs them by ranges. What reaches the driver is the filter
    itself in bytes, about 2 MB a million keys and never more than MOST_BITS / 8.
    Past that bound the filter lets more keys through, which costs verification,
    never a result.
    """

    def __init__(self, keys: DataFrame, column: str, count: int | None = None):
        spark = keys.sparkSession
        hashed = keys.filter(F.col(column).isNotNull()).select(F.xxhash64(column).alias("a"), F.xxhash64(F.lit(1), column).alias("b"))
        self.bits = bits = bits_for(keys.count() if count is None else count)

        def words(batches):
            own = np.zeros(bits // 64, np.uint64)
            for pdf in batches:
                a, b = pdf["a"].to_numpy().view(np.uint64), pdf["b"].to_numpy().view(np.uint64) | np.uint64(1)
                for p in _steps(a, b, bits):
                    np.bitwise_or.at(own, (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63)))
            at = np.flatnonzero(own)
            for i in range(0, len(at), 1 << 16):
                part = at[i : i + (1 << 16)]
                yield pd.DataFrame({"w": part, "v": own[part].view(np.int64)})

        def pack(pdf):
            own = np.zeros(RANGE, np.int64)
            own[pdf["w"].to_numpy() % RANGE] = pdf["v"].to_numpy()
            return pd.DataFrame({"r": [int(pdf["w"].iloc[0]) // RANGE], "b": [own.tobytes()]})

        ored = hashed.mapInPandas(words, "w long, v long").groupBy("w").agg(F.bit_or("v").alias("v"))
        filled = np.zeros(max(RANGE, bits // 64), np.uint64)
        for row in ored.groupBy(F.floor(F.col("w") / RANGE).alias("g")).applyInPandas(pack, "r long, b binary").toLocalIterator():
            filled[row.r * RANGE : (row.r + 1) * RANGE] = np.frombuffer(row.b, np.uint64)
        self.shared = spark.sparkContext.broadcast(filled)

    def might_contain(self, column: str) -> Column:
        shared, bits = self.shared, self.bits

        @F.pandas_udf("boolean")
        def test(a: pd.Series, b: pd.Series) -> pd.Series:
            h1, h2 = a.to_numpy().view(np.uint64), b.to_numpy().view(np.uint64) | np.uint64(1)
            ok = np.ones(len(h1), bool)
            for p in _steps(h1, h2, bits):
                ok &= (shared.value[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
            return pd.Series(ok)

        return test(F.xxhash64(column), F.xxhash64(F.lit(1), column))
