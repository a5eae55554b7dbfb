"""Nodes and edges as tables: matches and idempotent changes.

Changes are pure functions of the current table and the changes; nothing is
written in place. Keys are compared with nulls never equal. Of several changes of a
key, the one that counts is told by ``order``; without it, by the values themselves
(the smallest is the first, the largest the last), so that results never vary.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(changes: DataFrame, keys: list[str], order: str | None, last: bool) -> DataFrame:
    if order is None:
        rest = [c for c in changes.columns if c not in keys]
        pick = F.max if last else F.min
        return changes.groupBy(*keys).agg(pick(F.struct(*rest)).alias("_s")).select(*keys, "_s.*") if rest else changes.distinct()
    w = Window.partitionBy(*keys).orderBy(F.desc(order) if last else F.asc(order))
    return changes.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def create_nodes(current: DataFrame, new: DataFrame) -> DataFrame:
    return current.unionByName(new, allowMissingColumns=True)


def merge_nodes(current: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Insert what is absent, the first of each key; never update."""
    fresh = _one_per_key(new, keys, order, last=False).join(current.select(*keys), keys, "left_anti")
    return current.unionByName(fresh.select(*[c for c in fresh.columns if c in current.columns]), allowMissingColumns=True)


def _overlay(current: DataFrame, changes: DataFrame, keys: list[str], how: str) -> DataFrame:
    props = [c for c in changes.columns if c not in keys]
    moved = changes.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(p).alias(f"_n_{p}") for p in props], F.lit(True).alias("_hit"))
    on = reduce(lambda a, b: a & b, (F.col(k) == F.col(f"_k_{k}") for k in keys))
    joined = current.join(moved, on, how)
    cols = [F.coalesce(F.col(k), F.col(f"_k_{k}")).alias(k) if k in keys else F.when(F.col("_hit"), F.col(f"_n_{k}")).otherwise(F.col(k)).alias(k) if k in props else F.col(k) for k in current.columns]
    return joined.select(*cols, *[F.col(f"_n_{p}").alias(p) for p in props if p not in current.columns])


def merge_set(current: DataFrame, changes: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Insert or overwrite the given properties, the last change of each key; an explicit null clears one."""
    return _overlay(current, _one_per_key(changes, keys, order, last=True).drop(*([order] if order and order not in current.columns else [])), keys, "full")


def match_set(current: DataFrame, changes: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Overwrite the properties of rows that exist; other changes do nothing."""
    return _overlay(current, _one_per_key(changes, keys, order, last=True).drop(*([order] if order and order not in current.columns else [])), keys, "left")


def merge_edges(current: DataFrame, new: DataFrame) -> DataFrame:
    return current.unionByName(new).distinct()


def backfill(current: DataFrame, column: str, computed: Column) -> DataFrame:
    return current.withColumn(column, F.coalesce(F.col(column), computed))


def or_key_match(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], left_key: str, first: str) -> DataFrame:
    """Rows of ``right`` that match on any pair of keys; the smallest ``first`` for each left row.

    One equi-join a pair, united: an OR in the condition would become a nested loop.
    """
    hits = [left.join(right, left[a] == right[b]).select(left[left_key], right[first]) for a, b in pairs]
    return reduce(DataFrame.unionByName, hits).groupBy(left_key).agg(F.min(first).alias(first))


def property_diff(old: DataFrame, new: DataFrame, key: str, columns: list[str], drop_nulls: bool = False) -> DataFrame:
    """(key, property, old_value, new_value) of what changed, for keys on both sides; with ``drop_nulls`` a new null is no change."""
    o = old.select(key, *[F.col(c).cast("string").alias(f"_o_{c}") for c in columns])
    n = new.select(key, *[F.col(c).cast("string").alias(f"_n_{c}") for c in columns])
    entries = F.array(*[F.struct(F.lit(c).alias("property"), F.col(f"_o_{c}").alias("old_value"), F.col(f"_n_{c}").alias("new_value")) for c in columns])
    kept = (lambda e: ~e["old_value"].eqNullSafe(e["new_value"]) & e["new_value"].isNotNull()) if drop_nulls else (lambda e: ~e["old_value"].eqNullSafe(e["new_value"]))
    changed = F.filter(entries, kept)
    return o.join(n, key).select(key, F.explode(changed).alias("e")).select(key, "e.*")


def radical_edges(nodes: DataFrame, key: str, radicals: Column) -> DataFrame:
    """Edges (key, radical, position) from each node to its letters; positions from 1, blanks dropped."""
    return nodes.select(key, F.posexplode(radicals).alias("p", "radical")).filter("radical <> ''").select(key, "radical", (F.col("p") + 1).alias("position")).distinct()


def radical_nodes(edges: DataFrame) -> DataFrame:
    """(radical, position): the nodes that radical edges lead to."""
    return edges.select("radical", "position").distinct()


def bulk_update(current: DataFrame, changes: DataFrame, keys: list[str], order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The table after ``match_set``, and (keys, status) of each changed key: updated, or failed where no such row exists."""
    asked = changes.select(*keys).distinct()
    there = current.select(*keys).distinct()
    done = asked.join(there, keys, "left_semi").withColumn("status", F.lit("updated"))
    return match_set(current, changes, keys, order), done.unionByName(asked.join(there, keys, "left_anti").withColumn("status", F.lit("failed")))


def link_or_create(items: DataFrame, roots: DataFrame, words: DataFrame) -> DataFrame:
    """(item, status, word_key, reason) for items (item, root, plain, normal), roots (root), words (root, plain, normal, word).

    failed: the root is unknown or null; linked: a word under the root has the same
    plain or normal form; created: no word has, and all such items of one root and
    normal form share the one that their first makes. Equal plain forms have equal
    normal forms, so the normal form alone groups them.
    """
    known = items.join(roots.select(F.col("root").alias("_root")).distinct(), F.col("root") == F.col("_root"), "left")
    live = known.filter(F.col("_root").isNotNull()).drop("_root")
    keyed = words.select(F.col("root").alias("r"), F.col("plain").alias("k"), "word").unionByName(words.select(F.col("root").alias("r"), F.col("normal").alias("k"), "word"))
    best = keyed.groupBy("r", "k").agg(F.min("word").alias("word"))
    one = live.join(best.withColumnRenamed("word", "w1"), (F.col("root") == F.col("r")) & (F.col("plain") == F.col("k")), "left").drop("r", "k")
    two = one.join(best.withColumnRenamed("word", "w2"), (F.col("root") == F.col("r")) & (F.col("normal") == F.col("k")), "left")
    found = F.least("w1", "w2")
    done = two.select("item", F.when(found.isNotNull(), "linked").otherwise("created").alias("status"), F.coalesce(found.cast("string"), F.concat_ws("|", "root", "normal")).alias("word_key"), F.lit(None).cast("string").alias("reason"))
    why = F.when(F.col("root").isNull(), "no root").otherwise("root not found")
    failed = known.filter(F.col("_root").isNull()).select("item", F.lit("failed").alias("status"), F.lit(None).cast("string").alias("word_key"), why.alias("reason"))
    return done.unionByName(failed)


def upsert_action(incoming: DataFrame, current: DataFrame, key: str, version: str) -> DataFrame:
    """``incoming`` with action: skip (same version), update (key exists), create; of a repeated new key the first creates."""
    known = current.select(F.col(key).alias("_key"), F.col(version).alias("_version")).dropDuplicates(["_key"])
    nth = F.row_number().over(Window.partitionBy(key).orderBy(version))
    joined = incoming.withColumn("_nth", nth).join(known, F.col(key) == F.col("_key"), "left")
    action = F.when(F.col("_key").isNull() & (F.col("_nth") == 1), "create").when(F.col("_version").eqNullSafe(F.col(version)), "skip").otherwise("update")
    return joined.withColumn("action", action).drop("_key", "_version", "_nth")
