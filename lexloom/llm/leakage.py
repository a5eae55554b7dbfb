"""Evaluation passages inside training texts.

A text leaks an item if they share ``run`` consecutive words, that is run - 4
consecutive shingles of five words. Of the shingles of each such item window the
rarest over all documents must occur in a leaking text, so those alone (prefix
tokens of a containment of all) are joined; positions and lengths bound what is
left, and every surviving alignment is verified word by word over a window of the
item's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

SHINGLE = 5
#: Letter case, punctuation, symbols and Arabic vowel marks do not count; white space separates.
DROPPED = r"[\p{P}\p{S}ً-ٰٟ]+"


def plain_words(text: Column) -> Column:
    """The words of a text as they are compared; null for null."""
    words = F.split(F.regexp_replace(F.lower(text), DROPPED, ""), r"(?U)\s+")
    return F.filter(words, lambda w: w != "")


def with_shingles(df: DataFrame, words: str, out: str, size: int = SHINGLE) -> DataFrame:
    """``df`` with the hashes of ``size`` consecutive words, by first word.

    The hashes of the words are a column of their own, so that they are made once
    a text and not once a shingle. To explode the result take posexplode_outer: for
    the plain one the planner adds a filter that computes the whole array again.
    """
    hashed = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    starts = F.slice("_h", 1, F.greatest(F.size("_h") - (size - 1), F.lit(0)))
    grams = F.transform(starts, lambda h, i: F.xxhash64(h, *[F.get(F.col("_h"), i + k) for k in range(1, size)]))
    return hashed.withColumn(out, grams).drop("_h")


def find_leaks(docs: DataFrame, items: DataFrame, doc_key: str, doc_text: str, item_key: str, item_text: str, run: int = 10) -> DataFrame:
    """(doc_key, item_key) of all texts and items that share ``run`` consecutive words.

    ``run`` is at least five. Null or empty texts and items of fewer words share
    nothing. Repeated rows give one pair. Texts are compared whole. Either table may be
    empty. Other columns are ignored. Items may be many: their shingles are
    joined, and broadcast only if the planner finds their table small.
    """
    per_window = run - SHINGLE + 1
    known = stage(
        items.select(F.col(item_key).alias("_item"), plain_words(F.col(item_text)).alias("_iwords")).filter(F.size("_iwords") >= run).dropDuplicates(["_item", "_iwords"]),
        "items",
    )
    places = stage(with_shingles(known, "_iwords", "_grams").select("_item", F.size("_iwords").alias("_isize"), F.posexplode_outer("_grams").alias("_ipos", "_sh")).filter("_sh IS NOT NULL"), "item_shingles")
    texts = docs.select(F.col(doc_key).alias("_doc"), F.col(doc_text).alias("_text"))
    worded = texts.select("_doc", plain_words(F.col("_text")).alias("_words"))
    postings = stage(
        with_shingles(worded, "_words", "_grams")
        .select("_doc", F.size("_words").alias("_size"), F.posexplode_outer("_grams").alias("_pos", "_s"))
        .join(places.select(F.col("_sh").alias("_s")).distinct(), "_s"),
        "postings",
    )
    # Rarity over all documents; every window of the item keeps its rarest shingle.
    counted = places.join(postings.groupBy("_s").agg(F.count("*").alias("_n")), F.col("_sh") == F.col("_s"), "left")
    ahead = Window.partitionBy("_item").orderBy("_ipos").rowsBetween(0, per_window - 1)
    token = F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_sh").alias("sh"), F.col("_ipos").alias("at"))
    prefix = (
        counted.select("_item", "_isize", "_ipos", F.min(token).over(ahead).alias("_t"))
        .filter((F.col("_ipos") <= F.col("_isize") - run) & (F.col("_t.n") > 0))
        .select("_item", "_isize", F.col("_ipos").alias("_start"), F.col("_t.sh").alias("_s"), F.col("_t.at").alias("_at"))
    )
    # The window that starts _at - _start words before the hit must lie within the text.
    first = F.col("_pos") - (F.col("_at") - F.col("_start"))
    aligned = (
        postings.join(prefix, "_s")
        .filter((first >= 0) & (first + run <= F.col("_size")))
        .select("_doc", "_item", (F.col("_pos") - F.col("_at")).alias("_shift"))
        .distinct()
    )
    wanted = stage(aligned, "alignments")
    opened = texts.join(wanted.select("_doc").distinct(), "_doc", "left_semi").select("_doc", plain_words(F.col("_text")).alias("_words"))
    pairs = wanted.join(opened, "_doc").join(known, "_item")
    lo = F.greatest(F.lit(0), -F.col("_shift"))
    hi = F.least(F.size("_iwords"), F.size("_words") - F.col("_shift"))
    same = F.transform(F.sequence(lo, hi - 1), lambda i: F.when(F.get("_iwords", i) == F.get("_words", i + F.col("_shift")), "1").otherwise("0"))
    found = pairs.filter(hi - lo >= run).filter(F.concat_ws("", same).contains("1" * run))
    return found.select(F.col("_doc").alias(doc_key), F.col("_item").alias(item_key)).distinct()


def leak_report(leaks: DataFrame, item_key: str, doc_key: str) -> DataFrame:
    """Documents per leaked item."""
    return leaks.groupBy(item_key).agg(F.count(doc_key).alias("n_docs"))
