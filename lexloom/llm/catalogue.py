"""Queries over the language-model training operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from ..sources.tables import table
from .canonical import map_values, typed
from .conversations import rebuild
from .encoding import restore
from .leakage import find_leaks, leak_report
from .mixing import mix
from .pii import find_personal, redact
from .truncation import find_truncated


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "fb_jsons", "msg_id", "participants", "sender_name", "timestamp_ms", "content")
    sets = raw.select("participants").filter(F.col("participants").isNotNull()).distinct()
    read = stage(sets.select("participants", F.from_json("participants", "array<struct<name:string>>", {"mode": "PERMISSIVE"}).alias("a")), "participants")
    readable = read.filter(F.col("a").isNotNull() & (F.size("a") > 0) & F.col("participants").rlike(r"\]\s*$"))
    listed = readable.select("participants", F.explode("a.name").alias("name")).filter("name IS NOT NULL")
    # Every distinct text is repaired once: names however often they occur, contents by message.
    texts = (
        raw.select(F.lit("content").alias("kind"), F.col("msg_id").cast("string").alias("key"), F.col("content").alias("text"))
        .unionByName(raw.select(F.lit("name").alias("kind"), F.col("sender_name").alias("key"), F.col("sender_name").alias("text")).distinct())
        .unionByName(listed.select(F.lit("name").alias("kind"), F.col("name").alias("key"), F.col("name").alias("text")).distinct())
        .filter("text IS NOT NULL")
    )
    fixed = stage(restore(texts, ["kind", "key"], "text").filter("restored <> ''").distinct(), "restored")
    names = fixed.filter("kind = 'name'").select(F.col("key").alias("bad_name"), F.col("restored").alias("name_as_was"))
    contents = fixed.filter("kind = 'content'").select(F.col("key").cast("long").alias("msg_id"), F.col("restored").alias("content_as_was"))
    members = (
        listed.join(names, F.col("name") == F.col("bad_name"), "left")
        .groupBy("participants")
        .agg(F.array_sort(F.collect_set(F.coalesce("name_as_was", "name"))).alias("members"))
    )
    messages = (
        raw.join(names, F.col("sender_name") == F.col("bad_name"), "left")
        .join(contents, "msg_id", "left")
        .select("msg_id", "participants", F.coalesce("name_as_was", "sender_name").alias("sender"), "timestamp_ms", F.coalesce("content_as_was", "content").alias("content"))
    )
    return rebuild(messages, members).distinct()


def p2_sizes(spark: SparkSession, d: str) -> DataFrame:
    return p2_found(spark, d).groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.count_if(F.col("speaker_role") == "asker").alias("n_asked"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "fb_jsons", "msg_id", "content", "sender_name")
    fields = rows.unpivot("msg_id", ["content", "sender_name"], "field_name", "text")
    return restore(fields, ["msg_id", "field_name"], "text").distinct()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "canonical_word", "entry_id", "arabic")
    items = table(spark, d, "corpus_item", "corpus_id", "item_id", "lemma")
    lemmas = items.select(F.lit("corpus_item").alias("tbl"), "corpus_id", F.col("item_id").alias("row_id"), F.col("lemma").alias("value"))
    words = table(spark, d, "word", "word_id", "arabic").select(F.lit("word").alias("tbl"), F.lit(0).alias("corpus_id"), F.col("word_id").alias("row_id"), F.col("arabic").alias("value"))
    free = lemmas.unionByName(words).filter(typed(F.col("value"))).join(listed.select(F.col("arabic").alias("value")).distinct(), "value", "left_anti")
    mapped = map_values(free, "value", listed, "entry_id", "arabic")
    return free.join(mapped, "value").select("tbl", "corpus_id", "row_id", F.coalesce("entry_id", F.lit(-1)).alias("entry_id")).distinct()


def p5_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return p5_found(spark, d).groupBy("tbl").agg(F.count("*").alias("n_typed"), F.count_if(F.col("entry_id") == -1).alias("n_unmatched"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "fb_jsons", "msg_id", "content")
    return find_personal(rows, "content").select("msg_id", "pii_kind", "val").distinct()


def p7_redacted(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "fb_jsons", "msg_id", "content")
    return redact(rows, "content").select("msg_id", "redacted")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(table(spark, d, "documents", "doc_id", "text"), table(spark, d, "eval_items", "item_id", "text"), "doc_id", "text", "item_id", "text")


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    return leak_report(p8_found(spark, d), "item_id", "doc_id")


def _mixed(spark: SparkSession, d: str, exact: bool = False):
    docs = table(spark, d, "documents", "doc_id", "text", "source")
    return mix(docs, table(spark, d, "mix_targets", "source", "target_share", "max_repeats"), "doc_id", "text", "source", exact=exact)


def p9_chosen(spark: SparkSession, d: str) -> DataFrame:
    """The mix under one exponent, bisected to the entropy of the target shares."""
    return _mixed(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Weights and actual shares of ``p9_chosen``, and how far they are from the targets."""
    return _mixed(spark, d)[1]


def p9_exact(spark: SparkSession, d: str) -> DataFrame:
    """The mix that meets the target share of each source."""
    return _mixed(spark, d, exact=True)[0]


def p9_exact_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d, exact=True)[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return find_truncated(table(spark, d, "documents", "doc_id", "text", "source"), "doc_id", "text", "source").select("doc_id").distinct()


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text", "source")
    cut = find_truncated(docs, "doc_id", "text", "source").select("doc_id").distinct().withColumn("cut", F.lit(1))
    per = docs.select("doc_id", "source").join(cut, "doc_id", "left").groupBy("source")
    return per.agg(F.count("*").alias("n_docs"), F.count("cut").alias("n_cut"), F.round(F.count("cut") / F.count("*"), 6).alias("cut_rate"))


QUERIES = {
    "p2_found": p2_found,
    "p2_sizes": p2_sizes,
    "p3_found": p3_found,
    "p5_found": p5_found,
    "p5_unmatched": p5_unmatched,
    "p7_found": p7_found,
    "p7_redacted": p7_redacted,
    "p8_found": p8_found,
    "p8_items": p8_items,
    "p9_chosen": p9_chosen,
    "p9_shares": p9_shares,
    "p9_exact": p9_exact,
    "p9_exact_shares": p9_exact_shares,
    "p10_found": p10_found,
    "p10_rates": p10_rates,
}
_P8 = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, list_filter(regexp_split_to_array(regexp_replace(lower(text), '[\p{P}\p{S}\x{064B}-\x{065F}\x{0670}]+', '', 'g'), '\s+'), lambda x: x <> '') AS words FROM documents
  UNION ALL
  SELECT 'i', item_id, list_filter(regexp_split_to_array(regexp_replace(lower(text), '[\p{P}\p{S}\x{064B}-\x{065F}\x{0670}]+', '', 'g'), '\s+'), lambda x: x <> '') FROM eval_items),
g AS (SELECT kind, id, unnest(list_transform(range(1, len(words) - 8), lambda i: array_to_string(words[i:i+9], ' '))) AS gram FROM w WHERE len(words) >= 10)
SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM g d JOIN g i ON d.gram = i.gram WHERE d.kind = 'd' AND i.kind = 'i'
"""
SQL: dict[str, str] = {
    "p8_found": _P8,
    "p8_items": f"SELECT item_id, count(*) AS n_docs FROM ({_P8}) GROUP BY item_id",
}
