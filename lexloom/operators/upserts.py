"""Roots and words put into the graph: what each incoming row does, with the ids and edges it makes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import next_ids


def upsert_roots(incoming: DataFrame, current: DataFrame, spelling: str, outer: str, key: str, *properties: str) -> DataFrame:
    """(key, spelling, outer, *properties, action) of every incoming root.

    ``current`` has key, spelling and outer, the id in the source that it came
    from; ``incoming`` has spelling, outer and the properties. ``skip``: the root
    has this outer id already; ``update``: the root exists and gets outer id and
    properties; ``create``: it gets the next key. Of rows that repeat a new
    spelling the one with the smallest outer id creates and the others update. Rows
    without a spelling are left out.
    """
    rows = incoming.filter(F.col(spelling).isNotNull()).select(spelling, outer, *properties)
    there = current.filter(F.col(spelling).isNotNull()).groupBy(F.col(spelling).alias("_s")).agg(F.min(key).alias("_k"), F.collect_set(outer).alias("_outers"))
    met = rows.join(there, F.col(spelling) == F.col("_s"), "left")
    old = met.filter("_s IS NOT NULL").withColumn("action", F.when(F.array_contains("_outers", F.col(outer)), "skip").otherwise("update"))
    nth = F.row_number().over(Window.partitionBy(spelling).orderBy(F.asc_nulls_last(outer)))
    new = met.filter("_s IS NULL").withColumn("action", F.when(nth == 1, "create").otherwise("update")).drop("_k", "_s", "_outers")
    made = next_ids(current, new.filter("action = 'create'").select(spelling), key, [spelling]).select(F.col(spelling).alias("_s"), F.col(key).alias("_k"))
    every = old.drop("_s", "_outers").unionByName(new.join(made, F.col(spelling) == F.col("_s")).drop("_s"))
    return every.select(F.col("_k").alias(key), spelling, outer, *properties, "action")


def upsert_words(incoming: DataFrame, current: DataFrame, roots: DataFrame, word: str, lang: str, root: str, script: str) -> DataFrame:
    """(*incoming, action) of every incoming word: what is to be done with it.

    ``incoming`` and ``current`` have word, lang, root and script (the language the
    source gives); ``roots`` has root. ``unresolved``: no root is given; ``empty``: no
    word; ``update``: the word is there under the root without a script; ``skip``: it
    is there with one; ``create``, or ``create_root`` where the root has to be made as
    well. Of rows that repeat a new word, one creates and the others skip.
    """
    text = F.trim(F.col(word))
    there = current.select(F.trim(word).alias("_w"), F.col(lang).alias("_l"), F.col(root).alias("_r"), F.col(script).alias("_c")).groupBy("_w", "_l", "_r").agg(F.count("_c").alias("_scripts"))
    known = roots.select(F.col(root).alias("_known")).distinct()
    nth = F.row_number().over(Window.partitionBy(text, lang, root).orderBy(F.asc_nulls_last(script)))
    same = (text == F.col("_w")) & (F.col(lang) == F.col("_l")) & (F.col(root) == F.col("_r"))
    met = incoming.withColumn("_nth", nth).join(there, same, "left").join(known, F.col(root) == F.col("_known"), "left")
    action = (
        F.when(F.col(root).isNull(), "unresolved")
        .when(F.coalesce(text, F.lit("")) == "", "empty")
        .when(F.col("_scripts") == 0, "update")
        .when(F.col("_w").isNotNull() | (F.col("_nth") > 1), "skip")
        .when(F.col("_known").isNull(), "create_root")
        .otherwise("create")
    )
    return met.select(*[met[c] for c in incoming.columns], action.alias("action"))


def word_edges(judged: DataFrame, key: Column, root: str) -> DataFrame:
    """(rel, src_id, dst_id): the edges from created words to their roots."""
    made = judged.filter(F.col("action").isin("create", "create_root"))
    return made.select(F.lit("BELONGS_TO_ROOT").alias("rel"), key.alias("src_id"), F.col(root).alias("dst_id")).distinct()
