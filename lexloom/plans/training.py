"""Queries for training data over the general operators, with their SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hierarchy import descendants, resolve_hierarchy
from ..operators.latest import latest_version
from ..operators.packed_values import split_packed
from ..operators.references import find_orphans, orphan_report, parents
from ..sources.tables import table

ALIFS = "أإآٱ"


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return split_packed(table(spark, d, "output_for_graphdb", "row_id", "classification"), "row_id", "classification")


def p1_labels(spark: SparkSession, d: str) -> DataFrame:
    return p1_found(spark, d).groupBy("attr").agg(F.count("*").alias("n_values"), F.countDistinct("val").alias("n_distinct"))


def _current_words(spark: SparkSession, d: str) -> DataFrame:
    return latest_version(table(spark, d, "sem_word", "id", "root", "root_lang", "loaded_at"), "id", "loaded_at", "root", "root_lang")


def _derived() -> F.Column:
    return F.coalesce(F.col("root_lang").rlike(r"\S"), F.lit(False))


def root_spelling(root: F.Column) -> F.Column:
    """A typed root without separators and padding, any alif as alif; null if it is no reference."""
    letters = F.translate(F.regexp_replace(root, r"[^\p{L}]+", ""), ALIFS, "ا" * len(ALIFS))
    plain = F.trim(F.regexp_replace(root, r"(?U)^\s+|\s+$", ""))
    return F.when((plain == "") | plain.isin("NA", "None") | root.isNull(), None).otherwise(letters)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    words = _current_words(spark, d).filter(F.col("root").isNotNull())
    word_refs = words.select(
        F.lit("sem_word").alias("tbl"),
        F.lit(0).alias("corpus_id"),
        F.col("id").alias("row_id"),
        "loaded_at",
        F.concat(F.when(_derived(), "w:").otherwise("r:"), F.col("root").cast("string")).alias("ref"),
    )
    items = table(spark, d, "corpus_item", "corpus_id", "item_id", "root", "loaded_at")
    item_refs = items.select(
        F.lit("corpus_item").alias("tbl"), "corpus_id", F.col("item_id").alias("row_id"), "loaded_at", F.concat(F.lit("s:"), root_spelling(F.col("root"))).alias("ref")
    )
    roots = table(spark, d, "sem_root", "id", "rad1", "rad2", "rad3", "rad4", "loaded_at", "deleted_at")
    script = table(spark, d, "sem_lang", "id", "script").filter("id = 1").agg(F.max("script")).first()[0] or ""  # one alphabet
    letters = F.array(*map(F.lit, re.split(r"\s*,\s*", script)))
    radical = [F.coalesce(F.when(F.col(r) >= 0, F.get(letters, F.col(r))), F.lit("")) for r in ("rad1", "rad2", "rad3", "rad4")]
    loaded, deleted = F.col("loaded_at"), F.col("deleted_at")
    known = (
        parents(table(spark, d, "sem_word", "id", "loaded_at"), F.concat(F.lit("w:"), F.col("id").cast("string")), loaded)
        .unionByName(parents(roots, F.concat(F.lit("r:"), F.col("id").cast("string")), loaded, deleted))
        .unionByName(parents(roots, F.concat(F.lit("s:"), F.translate(F.concat(*radical), ALIFS, "ا" * len(ALIFS))), loaded, deleted))
    )
    found = find_orphans(word_refs.unionByName(item_refs), known, "ref", "loaded_at")
    return found.select("tbl", "corpus_id", "row_id", F.date_format("loaded_at", "yyyy-MM").alias("ref_month"), "orphan_kind").distinct()


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(p4_found(spark, d))


def _all_paths(spark: SparkSession, d: str) -> DataFrame:
    words = _current_words(spark, d)
    return words.select("id", F.when(_derived(), F.col("root")).alias("parent"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    links = _all_paths(spark, d)
    derived = F.col("parent").isNotNull()
    solved = resolve_hierarchy(links, "id", "parent")
    return solved.join(links.filter(derived).select("id"), "id", "left_semi").select("id", "top_id", "tree_depth", "id_path")


def p6_descendants(spark: SparkSession, d: str) -> DataFrame:
    pairs = descendants(resolve_hierarchy(_all_paths(spark, d), "id", "parent"))
    return pairs.groupBy("ancestor").agg(F.count("*").alias("n_descendants"), F.max("distance").cast("int").alias("height"))


QUERIES = {
    "p1_found": p1_found,
    "p1_labels": p1_labels,
    "p4_found": p4_found,
    "p4_report": p4_report,
    "p6_found": p6_found,
    "p6_descendants": p6_descendants,
}
_P4_FOUND = r"""
WITH cur AS (
  SELECT id, v.root AS root, coalesce(v.root_lang, '') AS root_lang, loaded_at FROM (
    SELECT id, arg_max({'root': root, 'root_lang': root_lang}, loaded_at) AS v, max(loaded_at) AS loaded_at FROM sem_word WHERE id IS NOT NULL GROUP BY id)),
refs AS (
  SELECT 'sem_word' AS tbl, 0 AS corpus_id, id AS row_id, loaded_at,
         CASE WHEN regexp_matches(root_lang, '\S') THEN 'w:' ELSE 'r:' END || root AS ref
  FROM cur WHERE root IS NOT NULL
  UNION ALL
  SELECT 'corpus_item', corpus_id, item_id, loaded_at,
         's:' || translate(regexp_replace(root, '[^\p{L}]+', '', 'g'), 'أإآٱ', 'اااا')
  FROM corpus_item WHERE root IS NOT NULL AND trim(root) NOT IN ('', 'NA', 'None')),
script AS (SELECT string_split(max(script), ',') AS letters FROM sem_lang WHERE id = 1),
spelled AS (
  SELECT coalesce(CASE WHEN rad1 >= 0 THEN letters[rad1 + 1] END, '') || coalesce(CASE WHEN rad2 >= 0 THEN letters[rad2 + 1] END, '')
      || coalesce(CASE WHEN rad3 >= 0 THEN letters[rad3 + 1] END, '') || coalesce(CASE WHEN rad4 >= 0 THEN letters[CAST(rad4 AS INT) + 1] END, '') AS spelling,
    loaded_at, deleted_at FROM sem_root, script),
known AS (
  SELECT 'w:' || id AS pkey, min(loaded_at) AS p_loaded, CAST(NULL AS TIMESTAMP) AS p_deleted FROM sem_word GROUP BY 1
  UNION ALL SELECT 'r:' || id, min(loaded_at), min(deleted_at) FROM sem_root GROUP BY 1
  UNION ALL SELECT 's:' || spelling, min(loaded_at), min(deleted_at) FROM spelled GROUP BY 1),
judged AS (
  SELECT r.*, CASE WHEN pkey IS NULL THEN 'missing' WHEN p_loaded > r.loaded_at THEN 'late' WHEN p_deleted <= r.loaded_at THEN 'deleted' END AS orphan_kind
  FROM refs r LEFT JOIN known k ON r.ref = k.pkey)
SELECT DISTINCT tbl, corpus_id, row_id, strftime(loaded_at, '%Y-%m') AS ref_month, orphan_kind FROM judged WHERE orphan_kind IS NOT NULL
"""
_PATHS = r"""
WITH RECURSIVE cur AS (
  SELECT id, v.root AS root, coalesce(v.root_lang, '') AS root_lang FROM (
    SELECT id, arg_max({'root': root, 'root_lang': root_lang}, loaded_at) AS v FROM sem_word WHERE id IS NOT NULL GROUP BY id)),
links AS (SELECT id, CASE WHEN regexp_matches(root_lang, '\S') THEN root END AS parent FROM cur),
down AS (
  SELECT l.id, l.id AS top_id, 0 AS tree_depth, CAST(l.id AS VARCHAR) AS id_path
  FROM links l LEFT JOIN links p ON l.parent = p.id WHERE p.id IS NULL
  UNION ALL
  SELECT l.id, d.top_id, d.tree_depth + 1, d.id_path || '/' || l.id FROM links l JOIN down d ON l.parent = d.id),
stuck AS (SELECT l.id, l.parent FROM links l WHERE l.id NOT IN (SELECT id FROM down)),
walk AS (
  SELECT id AS start, id, parent, 0 AS n FROM stuck
  UNION ALL
  SELECT w.start, s.id, s.parent, n + 1 FROM walk w JOIN stuck s ON s.id = w.parent WHERE n < (SELECT count(*) FROM stuck) AND w.parent <> w.start),
on_loop AS (SELECT DISTINCT start AS id FROM walk WHERE parent = start),
loop_ids AS (SELECT w.start, min(w.id) AS least, bool_or(w.start IN (SELECT id FROM on_loop)) AS is_on FROM walk w WHERE w.id IN (SELECT id FROM on_loop) GROUP BY w.start),
solved AS (
  SELECT id, top_id, tree_depth, id_path FROM down
  UNION ALL SELECT start, least, CASE WHEN is_on THEN -1 ELSE -2 END, '' FROM loop_ids)
"""
SQL: dict[str, str] = {
    "p4_found": _P4_FOUND,
    "p4_report": f"SELECT tbl, ref_month, orphan_kind, count(*) AS n_orphans FROM ({_P4_FOUND}) GROUP BY ALL",
    "p6_found": _PATHS + "SELECT s.* FROM solved s JOIN links l USING (id) WHERE l.parent IS NOT NULL",
    "p6_descendants": _PATHS
    + """, pairs AS (SELECT CAST(unnest(string_split(id_path, '/')) AS BIGINT) AS ancestor, generate_subscripts(string_split(id_path, '/'), 1) AS i,
         len(string_split(id_path, '/')) AS n FROM solved WHERE id_path <> '')
SELECT ancestor, count(*) AS n_descendants, CAST(max(n - i) AS INT) AS height FROM pairs WHERE i < n GROUP BY ancestor""",
}
