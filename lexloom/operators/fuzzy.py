"""Nearest entry of a word list within a small edit distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _neighbourhood(c: str, most: int):
    """The word and all that is left of it after up to ``most`` deletions, as an array."""
    out = F.array(F.col(c))
    level = out
    for _ in range(most):
        cut = F.flatten(F.transform(level, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))))
        level = F.array_distinct(cut)
        out = F.array_union(out, level)
    return out


def fuzzy_nearest(tokens: DataFrame, token: str, lexicon: DataFrame, word: str, ordinal: str, most: int = 2) -> DataFrame:
    """(token, word, distance): the nearest word within ``most`` edits, ties by ``ordinal``.

    Distinct tokens meet words that share a deletion neighbour, an equi-join, and
    only those pairs are measured. Tokens with none near are left out.
    """
    t = tokens.select(token).filter(F.col(token).isNotNull()).distinct()
    a = t.select(token, F.explode_outer(_neighbourhood(token, most)).alias("_near"))
    b = lexicon.select(word, ordinal, F.explode_outer(_neighbourhood(word, most)).alias("_near"))
    pairs = a.join(b, "_near").select(token, word, ordinal).distinct()
    near = pairs.withColumn("distance", F.levenshtein(token, word)).filter(F.col("distance") <= most)
    return near.groupBy(token).agg(F.min(F.struct("distance", ordinal, word)).alias("_m")).select(token, F.col(f"_m.{word}").alias(word), F.col("_m.distance").alias("distance"))
