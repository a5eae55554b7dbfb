"""One query for each operator of the lexical engine, with the SQL that must give the same rows."""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import tables as V
from ..functions import text as X
from ..operators import batches as B
from ..operators import documents as D
from ..operators import graph as G
from ..operators.fuzzy import fuzzy_nearest
from ..operators.latest import latest_version
from ..operators.numbering import first_seen, next_ids, number_rows, number_within
from ..sources.readers import read_csv, tolerant
from ..sources.tables import table
from ..sources.writers import split_rejects, write_csv
from ..session import scratch_root
from ..streaming.linker import daily_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _count(name="n"):
    return F.count("*").alias(name)


# -- projections, filters, predicates ---------------------------------------


@query("SELECT p_partkey AS word_id, p_name AS arabic, p_brand AS form FROM part")
def project_words(s, d):
    return table(s, d, "part", "p_partkey", "p_name", "p_brand").toDF("word_id", "arabic", "form")


@query("SELECT p_partkey FROM part WHERE p_size = 7 AND p_type = 'STANDARD' AND p_name IS NOT NULL")
def filter_property_map(s, d):
    return table(s, d, "part").filter((F.col("p_size") == 7) & (F.col("p_type") == "STANDARD") & F.col("p_name").isNotNull()).select("p_partkey")


@query("SELECT corpus_id, item_id, coalesce(nullif(lemma, 'NA'), nullif(arabic, 'NA'), nullif(root, 'NA')) AS first_value FROM (SELECT DISTINCT corpus_id, item_id, lemma, arabic, root FROM corpus_item) WHERE coalesce(nullif(lemma, 'NA'), nullif(arabic, 'NA'), nullif(root, 'NA')) IS NOT NULL")
def filter_or_family(s, d):
    family = F.coalesce(*[X.nullify(F.col(c), "NA") for c in ("lemma", "arabic", "root")])
    rows = table(s, d, "corpus_item", "corpus_id", "item_id", "lemma", "arabic", "root").distinct()
    return rows.select("corpus_id", "item_id", family.alias("first_value")).filter("first_value IS NOT NULL")


@query("SELECT count(*) AS n_rows, count(*) FILTER (WHERE root_lang IS NULL OR root_lang = '') AS n_unset, count(*) FILTER (WHERE meaning <> 'NA' AND meaning <> 'None') AS n_meant, count(*) FILTER (WHERE concept IS NOT NULL AND concept <> word) AS n_other, 0 AS n_equal_null FROM sem_word")
def filter_sentinel(s, d):
    c = F.col
    return table(s, d, "sem_word").agg(
        _count("n_rows"),
        F.count_if(c("root_lang").isNull() | (c("root_lang") == "")).alias("n_unset"),
        F.count_if(~c("meaning").isin("NA", "None")).alias("n_meant"),
        F.count_if(c("concept").isNotNull() & (c("concept") != c("word"))).alias("n_other"),
        F.count_if(c("concept") == F.lit(None)).cast("int").alias("n_equal_null"),
    )


@query("SELECT o_orderkey FROM orders WHERE NOT (o_orderkey BETWEEN 10 AND 99 OR o_orderkey BETWEEN 500 AND 700)")
def exclude_ranges(s, d):
    ranges = [(10, 99), (500, 700)]
    hit = F.lit(False)
    for a, b in ranges:
        hit = hit | F.col("o_orderkey").between(a, b)
    return table(s, d, "orders", "o_orderkey").filter(~hit)


@query("SELECT doc_id, CASE WHEN n_chars < 200 THEN 'short' WHEN lang IS NULL OR lang = 'und' THEN 'no language' WHEN source IS NULL THEN 'no source' ELSE 'ok' END AS reason FROM documents")
def validate_rows(s, d):
    c = F.col
    reason = F.when(c("n_chars") < 200, "short").when(c("lang").isNull() | (c("lang") == "und"), "no language").when(c("source").isNull(), "no source")
    ok, rejects = split_rejects(table(s, d, "documents", "doc_id", "n_chars", "lang", "source"), reason)
    return ok.select("doc_id", F.lit("ok").alias("reason")).unionByName(rejects.select("doc_id", F.col("reject_reason").alias("reason")))


@query("SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS n_words FROM documents WHERE len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) > 150")
def oversize_entries(s, d):
    n = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")).cast("long")
    return table(s, d, "documents", "doc_id", "text").select("doc_id", n.alias("n_words")).filter("n_words > 150")


@query("SELECT c_custkey, regexp_extract(upper(trim(c_name)), '^CUSTOMER#(\\d{4})(\\d{5})$', 1) AS session, CAST(regexp_extract(upper(trim(c_name)), '^CUSTOMER#(\\d{4})(\\d{5})$', 2) AS INT) AS part_no, row_number() OVER (PARTITION BY regexp_extract(upper(trim(c_name)), '^CUSTOMER#(\\d{4})(\\d{5})$', 1) ORDER BY c_name) AS n FROM customer WHERE regexp_matches(upper(trim(c_name)), '^CUSTOMER#(\\d{4})(\\d{5})$')")
def regex_parse(s, d):
    name, pattern = F.upper(F.trim("c_name")), r"^CUSTOMER#(\d{4})(\d{5})$"
    rows = table(s, d, "customer", "c_custkey", "c_name").filter(name.rlike(pattern))
    rows = rows.withColumn("session", F.regexp_extract(name, pattern, 1)).withColumn("part_no", F.regexp_extract(name, pattern, 2).cast("int"))
    return rows.select("c_custkey", "session", "part_no", F.row_number().over(Window.partitionBy("session").orderBy("c_name")).cast("long").alias("n"))


@query("SELECT CASE WHEN classification IS NULL OR trim(classification) = '' THEN 'empty' WHEN len(string_split(classification, '; ')) = 2 THEN 'valid' ELSE 'invalid' END AS kind, count(*) AS n FROM word GROUP BY 1")
def format_scan(s, d):
    c = F.col("classification")
    kind = F.when(c.isNull() | (F.trim(c) == ""), "empty").when(F.size(F.split(c, "; ")) == 2, "valid").otherwise("invalid")
    return table(s, d, "word", "classification").groupBy(kind.alias("kind")).agg(_count())


_CHANGED = "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN upper(c_mktsegment) || '!' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer"


def _changed(s, d):
    c = table(s, d, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    k = F.col("c_custkey")
    return c.select("c_custkey", F.when(k % 3 == 0, F.concat(F.upper("c_mktsegment"), F.lit("!"))).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), F.when(k % 5 == 0, None).otherwise(F.col("c_nationkey")).alias("c_nationkey"))


@query(f"""WITH n AS ({_CHANGED}) SELECT * FROM (
SELECT o.c_custkey, 'c_mktsegment' AS property, o.c_mktsegment AS old_value, n.c_mktsegment AS new_value FROM customer o JOIN n USING (c_custkey) WHERE o.c_mktsegment IS DISTINCT FROM n.c_mktsegment
UNION ALL SELECT o.c_custkey, 'c_nationkey', CAST(o.c_nationkey AS VARCHAR), CAST(n.c_nationkey AS VARCHAR) FROM customer o JOIN n USING (c_custkey) WHERE o.c_nationkey IS DISTINCT FROM n.c_nationkey)""")
def property_diff(s, d):
    return G.property_diff(table(s, d, "customer"), _changed(s, d), "c_custkey", ["c_mktsegment", "c_nationkey"])


# -- joins -------------------------------------------------------------------


@query("SELECT d.doc_id, r.concept FROM documents d JOIN (SELECT id, max(concept) AS concept FROM sem_root GROUP BY id) r ON d.root_id = r.id")
def lookup_join(s, d):
    roots = table(s, d, "sem_root", "id", "concept").groupBy("id").agg(F.max("concept").alias("concept"))
    return table(s, d, "documents", "doc_id", "root_id").join(roots, F.col("root_id") == F.col("id")).select("doc_id", "concept")


@query("SELECT a.p_partkey, b.s_suppkey, a.n AS ordinal FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS n FROM part) a JOIN (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS n FROM supplier) b USING (n)")
def positional_join(s, d):
    a = number_rows(table(s, d, "part", "p_partkey"), ["p_partkey"])
    b = number_rows(table(s, d, "supplier", "s_suppkey"), ["s_suppkey"])
    return a.join(b, "ordinal").select("p_partkey", "s_suppkey", "ordinal")


@query("SELECT w.word_id, c.entry_id FROM (SELECT DISTINCT word_id, arabic FROM word) w LEFT JOIN canonical_word c ON w.arabic = c.arabic")
def optional_match(s, d):
    w = table(s, d, "word", "word_id", "arabic").distinct()
    return w.join(table(s, d, "canonical_word", "entry_id", "arabic"), "arabic", "left").select("word_id", "entry_id")


@query("SELECT r_name, n_name, count(*) AS n FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey GROUP BY ALL")
def expand_path(s, d):
    path = table(s, d, "region").join(table(s, d, "nation"), F.col("r_regionkey") == F.col("n_regionkey")).join(table(s, d, "customer", "c_nationkey"), F.col("n_nationkey") == F.col("c_nationkey"))
    return path.groupBy("r_name", "n_name").agg(_count())


_FOLD = "translate(regexp_replace({}, '[\\x{{064B}}-\\x{{0655}}]', '', 'g'), 'أإآىة', 'ااايه')"


def _fold(c):
    return X.fold_letters(F.regexp_replace(c, X.WIDE_MARKS, ""))


@query(f"SELECT w.word_id, min(c.entry_id) AS entry_id FROM (SELECT DISTINCT word_id, arabic FROM word WHERE arabic IS NOT NULL) w JOIN canonical_word c ON w.arabic = c.arabic OR {_FOLD.format('w.arabic')} = {_FOLD.format('c.arabic')} GROUP BY w.word_id")
def or_key_match(s, d):
    w = table(s, d, "word", "word_id", "arabic").distinct().select("word_id", F.col("arabic").alias("plain"), _fold(F.col("arabic")).alias("normal"))
    c = table(s, d, "canonical_word", "entry_id", "arabic").select("entry_id", F.col("arabic").alias("c_plain"), _fold(F.col("arabic")).alias("c_normal"))
    return G.or_key_match(w, c, [("plain", "c_plain"), ("normal", "c_normal")], "word_id", "entry_id")


@query("SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM canonical_word c WHERE c.root_id = d.root_id)")
def unlinked_items(s, d):
    c = table(s, d, "canonical_word", "root_id")
    return table(s, d, "documents", "doc_id", "root_id").join(c, "root_id", "left_anti").select("doc_id")


@query("SELECT d.doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM canonical_word c WHERE c.root_id = d.root_id)")
def linked_items(s, d):
    c = table(s, d, "canonical_word", "root_id")
    return table(s, d, "documents", "doc_id", "root_id").join(c, "root_id", "left_semi").select("doc_id")


@query("""WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(lower(english), '[\\p{L}\\p{M}]+')) AS token FROM word WHERE english IS NOT NULL AND english <> 'NA'),
l AS (SELECT word, min(o) AS o FROM (SELECT unnest(regexp_extract_all(lower(p_name), '[\\p{L}\\p{M}]+')) AS word, p_partkey AS o FROM part) GROUP BY word),
m AS (SELECT token, word, levenshtein(token, word) AS distance, row_number() OVER (PARTITION BY token ORDER BY levenshtein(token, word), o, word) AS r FROM t, l WHERE levenshtein(token, word) <= 2)
SELECT token, word, CAST(distance AS INT) AS distance FROM m WHERE r = 1""")
def fuzzy_nearest_words(s, d):
    def whole(c):
        return F.explode(F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{M}]+"), F.lit(0)))
    tokens = table(s, d, "word", "english").select(whole(X.nullify(F.col("english"), "NA")).alias("token"))
    words = table(s, d, "part", "p_partkey", "p_name").select(whole(F.col("p_name")).alias("word"), F.col("p_partkey").alias("o"))
    lexicon = words.groupBy("word").agg(F.min("o").alias("o"))
    return fuzzy_nearest(tokens, "token", lexicon, "word", "o")


@query("SELECT a.corpus_id, a.sura_index, a.aya_index, a.word_position, count(*) AS n FROM (SELECT DISTINCT corpus_id, item_id, sura_index, aya_index, word_position FROM corpus_item) a JOIN (SELECT DISTINCT corpus_id, sura_index, aya_index, word_position FROM corpus_item WHERE part_of_speech = 'noun') b USING (corpus_id, sura_index, aya_index, word_position) GROUP BY ALL")
def composite_match(s, d):
    keys = ["corpus_id", "sura_index", "aya_index", "word_position"]
    items = table(s, d, "corpus_item", "item_id", "part_of_speech", *keys)
    return items.select("item_id", *keys).distinct().join(items.filter("part_of_speech = 'noun'").select(*keys).distinct(), keys).groupBy(*keys).agg(_count())


@query("WITH w AS (SELECT id, v.root AS root, v.root_lang AS root_lang FROM (SELECT id, arg_max({'root': root, 'root_lang': root_lang}, loaded_at) AS v FROM sem_word WHERE id IS NOT NULL GROUP BY id)) SELECT c.id, CASE WHEN trim(coalesce(c.root_lang, '')) <> '' THEN p.root ELSE c.root END AS resolved FROM w c LEFT JOIN w p ON c.root = p.id")
def parent_resolve(s, d):
    w = latest_version(table(s, d, "sem_word", "id", "root", "root_lang", "loaded_at"), "id", "loaded_at", "root", "root_lang")
    p = w.select(F.col("id").alias("p_id"), F.col("root").alias("p_root"))
    derived = F.trim(F.coalesce("root_lang", F.lit(""))) != ""
    return w.join(p, F.col("root") == F.col("p_id"), "left").select("id", F.when(derived, F.col("p_root")).otherwise(F.col("root")).alias("resolved"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem) WHERE n <= 3")
def top3_children(s, d):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    rows = table(s, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rows.withColumn("n", F.row_number().over(w).cast("long")).filter("n <= 3")


@query("SELECT l_linenumber, l_linestatus, CASE WHEN l_linestatus = 'O' THEN [NULL, 'فَعَلَ', 'فَاعَلَ', 'فَعَّلَ', 'أَفْعَلَ', 'تَفَعَّلَ', 'تَفَاعَلَ', 'انْفَعَلَ'][l_linenumber + 1] WHEN l_linenumber <= 4 THEN ['فَعْلَلَ', 'تَفَعْلَلَ', 'افْعَنْلَلَ', 'افْعَلَلَّ'][l_linenumber] END AS weight, count(*) AS n FROM lineitem GROUP BY ALL")
def weights(s, d):
    code = F.concat(F.when(F.col("l_linestatus") == "O", "").otherwise("R. Q. "), F.col("l_linenumber").cast("string"))
    rows = table(s, d, "lineitem", "l_linenumber", "l_linestatus")
    return rows.groupBy("l_linenumber", "l_linestatus", V.weight_of(code).alias("weight")).agg(_count())


@query("SELECT doc_id, len(regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}]+|[^\\s\\p{L}\\p{M}\\p{N}]')) AS n_tokens FROM documents")
def token_counts(s, d):
    return table(s, d, "documents", "doc_id", "text").select("doc_id", V.token_count(F.col("text")).cast("long").alias("n_tokens"))


@query("SELECT o_orderkey, count(*) AS n_lines, CAST(sum(l_linenumber) AS BIGINT) AS line_sum FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def nested_rows(s, d):
    lines = table(s, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("lines"))
    pages = table(s, d, "orders", "o_orderkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "lines")
    return D.nested_rows(pages, "lines").groupBy("o_orderkey").agg(_count("n_lines"), F.sum("l_linenumber").alias("line_sum"))


@query("SELECT CASE form WHEN 'I' THEN '1' WHEN 'II' THEN '2' WHEN 'III' THEN '3' WHEN 'IV' THEN '4' ELSE 'UNKNOWN' END AS form_id, count(*) AS n FROM word GROUP BY 1")
def dictionary_lookup(s, d):
    forms = {"I": "1", "II": "2", "III": "3", "IV": "4"}
    return table(s, d, "word", "form").groupBy(X.lookup(F.col("form"), forms, F.lit("UNKNOWN")).alias("form_id")).agg(_count())


@query("SELECT c.c_custkey, n.n_name, o.o_orderkey FROM customer c, (VALUES ('BUILDING'), ('MACHINERY')) v(seg), nation n, orders o WHERE c.c_mktsegment = v.seg AND n.n_nationkey = c.c_nationkey AND o.o_custkey = c.c_custkey")
def literal_links(s, d):
    wanted = s.createDataFrame([("BUILDING",), ("MACHINERY",)], "seg string")
    c = table(s, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment").join(wanted, F.col("c_mktsegment") == F.col("seg"))
    n, o = table(s, d, "nation", "n_nationkey", "n_name"), table(s, d, "orders", "o_orderkey", "o_custkey")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(o, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "n_name", "o_orderkey")


@query(f"""WITH a AS (SELECT DISTINCT word_id, {_FOLD.format("trim(arabic, ' ')")} AS k FROM word WHERE arabic IS NOT NULL), c AS (SELECT entry_id, {_FOLD.format("arabic")} AS k FROM canonical_word) SELECT a.word_id, c.entry_id FROM a JOIN c USING (k)""")
def normalised_join(s, d):
    a = table(s, d, "word", "word_id", "arabic").select("word_id", _fold(F.trim("arabic")).alias("k")).filter("k IS NOT NULL").distinct()
    return a.join(table(s, d, "canonical_word").select("entry_id", _fold(F.col("arabic")).alias("k")), "k").select("word_id", "entry_id")


# -- aggregates and numbering -------------------------------------------------


@query("SELECT * FROM (SELECT 'arabic' AS key, count(arabic) AS n FROM word UNION ALL SELECT 'english', count(english) FROM word UNION ALL SELECT 'wazn', count(wazn) FROM word UNION ALL SELECT 'form', count(form) FROM word UNION ALL SELECT 'classification', count(classification) FROM word)")
def null_profile(s, d):
    keys = ["arabic", "english", "wazn", "form", "classification"]
    one = table(s, d, "word", *keys).agg(*[F.count(k).alias(k) for k in keys])
    return one.unpivot([], keys, "key", "n")


@query("SELECT token, n FROM (SELECT token, count(*) AS n, min(doc_id) AS f FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents) GROUP BY token) ORDER BY n DESC, f, token LIMIT 50")
def pattern_frequency(s, d):
    t = table(s, d, "documents", "doc_id", "text").select("doc_id", F.explode_outer(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("token")).filter("token IS NOT NULL")
    return t.groupBy("token").agg(_count(), F.min("doc_id").alias("f")).orderBy(F.desc("n"), "f", "token").limit(50).select("token", "n")


@query("SELECT p_type, p_brand, n, example, 'M' || row_number() OVER (ORDER BY f) AS form_id FROM (SELECT p_type, p_brand, count(*) AS n, arg_min(p_name, p_partkey) AS example, min(p_partkey) AS f FROM part GROUP BY ALL)")
def form_catalogue(s, d):
    seen = first_seen(table(s, d, "part", "p_type", "p_brand", "p_partkey"), ["p_type", "p_brand"], "p_partkey", "no")
    per = table(s, d, "part").groupBy("p_type", "p_brand").agg(_count(), F.min_by("p_name", "p_partkey").alias("example"))
    return per.join(seen, ["p_type", "p_brand"]).select("p_type", "p_brand", "n", "example", F.concat(F.lit("M"), F.col("no").cast("string")).alias("form_id"))


@query("SELECT c_custkey, c_mktsegment, coalesce(m, 0) + row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS new_id FROM customer LEFT JOIN (SELECT c_mktsegment, max(c_custkey) AS m FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1) USING (c_mktsegment) WHERE c_custkey % 2 = 1")
def next_ids_per_type(s, d):
    c = table(s, d, "customer", "c_custkey", "c_mktsegment")
    top = c.filter("c_custkey % 2 = 0").groupBy("c_mktsegment").agg(F.max("c_custkey").alias("m"))
    numbered = number_within(c.filter("c_custkey % 2 = 1"), ["c_mktsegment"], ["c_custkey"])
    return numbered.join(top, "c_mktsegment", "left").select("c_custkey", "c_mktsegment", (F.coalesce("m", F.lit(0)) + F.col("n")).alias("new_id"))


@query("SELECT (SELECT coalesce(max(entry_id), 0) FROM canonical_word) + row_number() OVER (ORDER BY s_suppkey) AS entry_id, s_suppkey FROM supplier")
def next_ids_global(s, d):
    return next_ids(table(s, d, "canonical_word", "entry_id"), table(s, d, "supplier", "s_suppkey"), "entry_id", ["s_suppkey"]).select("entry_id", "s_suppkey")


@query("SELECT corpus_id, sura_index, aya_index, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT corpus_id, item_id, sura_index, aya_index FROM corpus_item) GROUP BY 1, 2, 3")
def collect_positions(s, d):
    items = table(s, d, "corpus_item", "corpus_id", "item_id", "sura_index", "aya_index").distinct()
    return items.groupBy("corpus_id", "sura_index", "aya_index").agg(_count(), F.concat_ws(",", F.transform(F.array_sort(F.collect_list("item_id")), lambda x: x.cast("string"))).alias("items"))


@query("SELECT corpus_id, item_id, row_number() OVER (PARTITION BY corpus_id, sura_index, aya_index ORDER BY item_id) AS position FROM (SELECT DISTINCT corpus_id, item_id, sura_index, aya_index FROM corpus_item)")
def word_positions(s, d):
    items = table(s, d, "corpus_item", "corpus_id", "item_id", "sura_index", "aya_index").distinct()
    w = Window.partitionBy("corpus_id", "sura_index", "aya_index").orderBy("item_id")
    return items.select("corpus_id", "item_id", F.row_number().over(w).cast("long").alias("position"))


_DOCSQL = "SELECT file_name, {y} min(timestamp_ms) AS conversation_start, count(*) AS n_messages FROM fb_jsons WHERE timestamp_ms > 0 GROUP BY ALL"


@query(f"SELECT *, CAST(month(make_timestamp(conversation_start * 1000)) AS INT) AS month, CAST(day(make_timestamp(conversation_start * 1000)) AS INT) AS day, CAST(hour(make_timestamp(conversation_start * 1000)) AS INT) AS hour, dayname(make_timestamp(conversation_start * 1000)) AS weekday FROM ({_DOCSQL.format(y='')})")
def conversation_docs(s, d):
    return D.conversation_docs(table(s, d, "fb_jsons", "file_name", "timestamp_ms").filter("timestamp_ms > 0"), "file_name", "timestamp_ms")


@query("SELECT file_name, CAST(year(make_timestamp(timestamp_ms * 1000)) AS INT) AS year, min(timestamp_ms) AS conversation_start, count(*) AS n_messages FROM fb_jsons WHERE timestamp_ms > 0 GROUP BY ALL")
def yearly_docs(s, d):
    rows = D.conversation_docs(table(s, d, "fb_jsons", "file_name", "timestamp_ms").filter("timestamp_ms > 0"), "file_name", "timestamp_ms", by_year=True)
    return rows.select("file_name", "year", "conversation_start", "n_messages")


@query("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, count(*) AS n FROM events GROUP BY user_id")
def set_key_groups(s, d):
    return table(s, d, "events", "user_id", "event_type").groupBy("user_id").agg(D.set_key(F.collect_set("event_type")).alias("types"), _count())


@query("SELECT count(*) AS processed, count(*) FILTER (WHERE deleted_at IS NULL) AS kept, count(*) FILTER (WHERE rad4 IS NULL) AS triliteral, count(*) FILTER (WHERE rad4 IS NOT NULL) AS quadriliteral, round(count(*) FILTER (WHERE deleted_at IS NULL) / greatest(count(*), 1) * 100, 6) AS success FROM sem_root")
def run_statistics(s, d):
    live = F.count_if(F.col("deleted_at").isNull())
    return table(s, d, "sem_root", "rad4", "deleted_at").agg(
        _count("processed"), live.alias("kept"), F.count_if(F.col("rad4").isNull()).alias("triliteral"), F.count_if(F.col("rad4").isNotNull()).alias("quadriliteral"), F.round(X.percent(live, F.count("*")), 6).alias("success")
    )


@query("SELECT l_orderkey, " + ", ".join(f"arg_max(l_returnflag, {{'p': l_partkey, 's': l_suppkey, 'f': l_returnflag}}) FILTER (WHERE l_linenumber = {i}) AS s{i}_flag" for i in (1, 2, 3)) + " FROM lineitem GROUP BY l_orderkey")
def segments_pivot(s, d):
    rows = table(s, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    place = F.struct("l_partkey", "l_suppkey", "l_returnflag")  # of rows that repeat a line the last by place counts
    return rows.groupBy("l_orderkey").agg(*[F.max_by("l_returnflag", F.when(F.col("l_linenumber") == i, place)).alias(f"s{i}_flag") for i in (1, 2, 3)])


@query("SELECT source, row_number() OVER (ORDER BY f) AS seen_no FROM (SELECT source, min(doc_id) AS f FROM documents WHERE source IS NOT NULL GROUP BY source)")
def dense_renumber(s, d):
    return first_seen(table(s, d, "documents", "source", "doc_id").filter("source IS NOT NULL"), ["source"], "doc_id").select("source", "seen_no")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, last_value(CASE WHEN l_returnflag = 'R' THEN l_partkey END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header FROM lineitem")
def forward_fill(s, d):
    rows = table(s, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").withColumn("o", F.struct("l_linenumber", "l_partkey", "l_suppkey"))
    return D.fill_headers(rows, "l_orderkey", "o", F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).drop("o", "l_returnflag")


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS item_id FROM documents WHERE source IS NOT NULL")
def running_item_id(s, d):
    return number_rows(table(s, d, "documents", "doc_id", "source").filter("source IS NOT NULL"), ["doc_id"], "item_id").select("doc_id", "item_id")


# -- scalar functions ---------------------------------------------------------


@query(f"SELECT entry_id, arabic, {_FOLD.format('arabic')} AS normal FROM canonical_word")
def fold_words(s, d):
    return table(s, d, "canonical_word", "entry_id", "arabic").select("entry_id", "arabic", _fold(F.col("arabic")).alias("normal"))


_MARK, _NARROW = r"[\x{064B}-\x{0655}]", r"[\x{064B}-\x{0652}]"


def _decomposed(column: str) -> str:
    """SQL for NFKD of letters in Latin and Arabic script; the order of marks, which the queries take off, is left as it is."""
    blocks = (0xA0, 0x250), (0x600, 0x700), (0x1E00, 0x1F00), (0xFB50, 0xFE00), (0xFE70, 0xFF00)
    pairs = [(chr(i), n) for lo, hi in blocks for i in range(lo, hi) if (n := unicodedata.normalize("NFKD", chr(i))) != chr(i)]
    keys, values = (", ".join("'" + x.replace("'", "''") + "'" for x in side) for side in zip(*pairs))
    return f"array_to_string(list_transform(string_split({column}, ''), lambda c: coalesce(m[c], c)), '') AS nfkd FROM (SELECT *, map([{keys}], [{values}]) AS m FROM"


@query(f"SELECT lemma, regexp_replace(nfkd, '{_MARK}', '', 'g') AS plain, regexp_replace(nfkd, '{_NARROW}', '', 'g') AS narrow, translate(regexp_replace(nfkd, '{_MARK}', '', 'g'), '{X.FOLD_FROM}', '{X.FOLD_TO}') AS normal FROM (SELECT lemma, {_decomposed('lemma')} (SELECT DISTINCT lemma FROM corpus_item WHERE lemma IS NOT NULL)))")
def strip_and_normalize(s, d):
    c = table(s, d, "corpus_item", "lemma").filter("lemma IS NOT NULL").distinct()
    return c.select("lemma", X.strip_marks(F.col("lemma")).alias("plain"), X.strip_marks(F.col("lemma"), wide=False).alias("narrow"), X.normalize_arabic(F.col("lemma")).alias("normal"))




@query(rf"SELECT DISTINCT arabic, regexp_replace(regexp_replace(regexp_replace(regexp_replace(arabic, '^[اٱ]?ل(..)', '\1'), '^{_MARK}{{1,2}}', ''), '^\x{{0651}}', ''), '{_MARK}(\n?)$', '\1') AS bare FROM word WHERE arabic IS NOT NULL")
def article_strip(s, d):
    w = table(s, d, "word", "arabic").filter(F.col("arabic").isNotNull()).distinct()
    return w.select("arabic", X.strip_article(F.col("arabic"), alif=True).alias("bare"))


@query(rf"SELECT DISTINCT arabic, regexp_replace(regexp_replace(regexp_replace(regexp_replace(arabic, '^ٱ?ل', ''), '^{_NARROW}{{1,2}}', ''), '^\x{{0651}}', ''), '{_NARROW}(\n?)$', '\1') AS bare FROM word WHERE arabic IS NOT NULL")
def article_strip_plain(s, d):
    w = table(s, d, "word", "arabic").filter(F.col("arabic").isNotNull()).distinct()
    return w.select("arabic", X.strip_article(F.col("arabic")).alias("bare"))


@query("SELECT DISTINCT lemma, CASE WHEN length(lemma) = 3 THEN lemma[1] || '-' || lemma[2] || '-' || lemma[3] END AS root, CASE WHEN length(lemma) = 3 THEN lemma[3] END AS r3, CASE WHEN length(lemma) = 3 THEN lemma[2] END AS r2, CASE WHEN length(lemma) = 3 THEN lemma[1] END AS r1 FROM corpus_item WHERE lemma IS NOT NULL")
def three_letter_roots(s, d):
    rows = table(s, d, "corpus_item", "lemma").filter("lemma IS NOT NULL").distinct()
    return rows.select("lemma", X.three_letters(F.col("lemma")).alias("x")).select("lemma", "x.root", "x.r3", "x.r2", "x.r1")


@query(f"SELECT DISTINCT lemma, translate(lemma, '{X.BUCKWALTER.replace(chr(39), chr(39) * 2)}', '{X.ARABIC}') AS arabic FROM corpus_item WHERE regexp_full_match(lemma, '[{"".join(chr(92) + x if not x.isalnum() else x for x in X.BUCKWALTER).replace(chr(39), chr(39) * 2)}]+')")
def buckwalter(s, d):
    letters = "".join("\\" + x if not x.isalnum() else x for x in X.BUCKWALTER)
    rows = table(s, d, "corpus_item", "lemma").filter(F.col("lemma").rlike(rf"^[{letters}]+\z")).distinct()
    return rows.select("lemma", X.to_arabic(F.col("lemma")).alias("arabic"))


@query("SELECT p_partkey, array_to_string(regexp_extract_all(p_brand, '.'), '-') AS dashed FROM part")
def hyphenate(s, d):
    return table(s, d, "part", "p_partkey", "p_brand").select("p_partkey", X.hyphenate(F.col("p_brand")).alias("dashed"))


_LETTER = "CASE WHEN {0} IS NULL THEN NULL WHEN {0} BETWEEN 0 AND 27 THEN '" + X.ALPHABET + "'[CAST({0} AS INT) + 1] ELSE '?' || CAST({0} AS INT) END"


@query(f"SELECT DISTINCT id, rad1, rad2, rad3, rad4, concat_ws('-', {', '.join(_LETTER.format(f'rad{i}') for i in (1, 2, 3, 4))}) AS root, CASE WHEN rad4 IS NULL THEN 'Triliteral' ELSE 'Quadriliteral' END AS root_type FROM sem_root")
def root_reconstruct(s, d):
    rads = ["rad1", "rad2", "rad3", "rad4"]
    rows = table(s, d, "sem_root", "id", *rads).distinct()
    return rows.select("id", *rads, X.reconstruct_root(*map(F.col, rads)).alias("root"), X.radical_type(F.col("rad4")).alias("root_type"))


@query("SELECT CASE len(list_distinct(string_split(root, '-'))) WHEN 2 THEN 'Geminate' WHEN 3 THEN 'Triliteral' WHEN 4 THEN 'Quadriliteral' WHEN 5 THEN 'Quintiliteral' WHEN 6 THEN 'Hexaliteral' WHEN 7 THEN 'Heptaliteral' ELSE 'BeyondSeptiliteral' END AS root_class, count(*) AS n FROM corpus_item WHERE root IS NOT NULL GROUP BY 1")
def root_classes(s, d):
    return table(s, d, "corpus_item", "root").filter("root IS NOT NULL").groupBy(X.root_class(F.col("root")).alias("root_class")).agg(_count())


@query("SELECT p_partkey, CASE WHEN len(list_filter(string_split(p_name, ' '), lambda w: w <> '')) > 2 THEN 'Phrase' WHEN ends_with(trim(p_name), 'e') THEN 'Verb' ELSE 'Noun' END AS word_type FROM part WHERE trim(p_name) <> ''")
def word_types(s, d):
    return table(s, d, "part", "p_partkey", "p_name").filter("trim(p_name) <> ''").select("p_partkey", X.word_type(F.col("p_name"), "e").alias("word_type"))


@query("SELECT row_id, CASE WHEN regexp_matches(v1, '\\p{L}') THEN v1 ELSE '' END AS lemma, CASE WHEN regexp_matches(v2, '\\p{L}') THEN v2 ELSE '' END AS pattern FROM (SELECT DISTINCT row_id, string_split(string_split(classification, ',')[2], ': ')[2] AS v1, string_split(string_split(classification, ',')[3], ': ')[2] AS v2 FROM output_for_graphdb WHERE classification IS NOT NULL)")
def classification_parts(s, d):
    rows = table(s, d, "output_for_graphdb", "row_id", "classification").filter("classification IS NOT NULL")
    c = F.col("classification")
    return rows.select("row_id", X.classification_part(c, 1).alias("lemma"), X.classification_part(c, 2).alias("pattern")).distinct()


@query("SELECT nullif(string_split(classification, '; ')[1], 'NA') AS cls, nullif(string_split(classification, '; ')[2], 'NA') AS sub, count(*) AS n FROM word WHERE len(string_split(classification, '; ')) = 2 GROUP BY 1, 2")
def split_classes(s, d):
    return table(s, d, "word").select(X.split_class(F.col("classification")).alias("p")).filter("p IS NOT NULL").groupBy("p.cls", "p.sub").agg(_count())


_FEATURES = "l_returnflag || '|LEM:' || l_linestatus || l_linenumber || '|' || CASE WHEN l_linenumber % 2 = 0 THEN 'M' ELSE 'F' END"


@query(f"SELECT lem, by_token, by_substring, count(*) AS n FROM (SELECT regexp_extract({_FEATURES}, 'LEM:([^|]*)', 1) AS lem, CASE WHEN l_linenumber % 2 = 0 THEN 'masculine' ELSE 'feminine' END AS by_token, contains({_FEATURES}, 'M') AS by_substring FROM lineitem) GROUP BY ALL")
def feature_flags(s, d):
    line = F.col("l_linenumber")
    f = F.concat("l_returnflag", F.lit("|LEM:"), "l_linestatus", line.cast("string"), F.lit("|"), F.when(line % 2 == 0, "M").otherwise("F"))
    rows = table(s, d, "lineitem", "l_returnflag", "l_linestatus", "l_linenumber").select(f.alias("f"))
    return rows.groupBy(X.feature_value(F.col("f"), "LEM").alias("lem"), X.feature_flag(F.col("f"), {"M": "masculine", "F": "feminine"}).alias("by_token"), F.col("f").contains("M").alias("by_substring")).agg(_count())


@query("SELECT DISTINCT corpus_id, item_id, concat_ws(':', sura_index, aya_index, word_position) AS location FROM (SELECT corpus_id, item_id, CAST(sura_index AS INT) AS sura_index, CAST(aya_index AS INT) AS aya_index, word_position FROM corpus_item)")
def location_strings(s, d):
    rows = table(s, d, "corpus_item", "corpus_id", "item_id", "sura_index", "aya_index", "word_position")
    return rows.select("corpus_id", "item_id", F.concat_ws(":", *[F.col(c).cast("string") for c in ("sura_index", "aya_index", "word_position")]).alias("location")).distinct()


@query("SELECT CAST(sum(a) AS BIGINT) AS a, CAST(sum(b) AS BIGINT) AS b, count(*) AS n FROM (SELECT CAST(l_linenumber AS BIGINT) AS a, CAST(l_quantity AS BIGINT) AS b FROM lineitem)")
def parse_locations(s, d):
    loc = F.concat(F.lit("("), F.col("l_linenumber").cast("string"), F.lit(":"), F.col("l_quantity").cast("long").cast("string"), F.lit(":1:1)"))
    p = table(s, d, "lineitem", "l_linenumber", "l_quantity").select(X.parse_location(loc).alias("p"))
    return p.agg(F.sum(F.col("p")[0]).alias("a"), F.sum(F.col("p")[1]).alias("b"), _count())


@query("SELECT doc_id, CASE WHEN length(text) > 300 THEN left(text, 300) || '...' ELSE text END AS cut FROM documents")
def truncate_ellipsis(s, d):
    return table(s, d, "documents", "doc_id", "text").select("doc_id", X.ellipsis(F.col("text"), 300).alias("cut"))


@query("SELECT p_partkey, translate(p_name, ' /', '__') || '.md' AS slug, trim(replace(replace(p_name, ',', ''), '/', ' or ')) AS title FROM part")
def slug_titles(s, d):
    return table(s, d, "part", "p_partkey", "p_name").select("p_partkey", X.slug(F.col("p_name")).alias("slug"), X.clean_title(F.col("p_name")).alias("title"))


@query("SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS INT), -1) AS k FROM events")
def json_extract(s, d):
    return table(s, d, "events", "event_id", "props").select("event_id", F.coalesce(F.get_json_object("props", "$.k").try_cast("int"), F.lit(-1)).alias("k"))


@query("SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour, dayname(ts) AS weekday FROM events")
def date_parts(s, d):
    t = F.col("ts")
    return table(s, d, "events", "event_id", "ts").select("event_id", F.year(t).cast("long").alias("year"), F.month(t).cast("long").alias("month"), F.dayofmonth(t).cast("long").alias("day"), F.hour(t).cast("long").alias("hour"), F.date_format(t, "EEEE").alias("weekday"))


@query("SELECT doc_id, i AS position, w AS word FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '') AS ws FROM documents))")
def token_positions(s, d):
    ws = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    return table(s, d, "documents", "doc_id", "text").select("doc_id", F.posexplode_outer(ws).alias("p", "word")).filter("word IS NOT NULL").select("doc_id", (F.col("p") + 1).cast("long").alias("position"), "word")


@query("SELECT doc_id, i AS line_number, trim(l) AS line FROM (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)) WHERE trim(l) <> ''")
def text_lines(s, d):
    lines = table(s, d, "documents", "doc_id", "text").select("doc_id", F.posexplode_outer(F.split("text", "\n")).alias("p", "l"))
    return lines.select("doc_id", (F.col("p") + 1).cast("long").alias("line_number"), F.trim("l").alias("line")).filter("line <> ''")


# The markup is '<form><h1>id</h1><p>text</p></form>': its texts are 'id; text', its Markdown '# id', a blank line and the text.
@query(r"SELECT doc_id, length(doc_id::VARCHAR) + CASE WHEN regexp_matches(text, '\S') THEN 2 + length(regexp_replace(text, '^\s+|\s+$', '', 'g')) ELSE 0 END AS n_text, length(regexp_replace('# ' || doc_id || chr(10) || chr(10) || text, '\s+$', '')) AS n_markdown FROM documents")
def xml_and_markdown(s, d):
    t = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    doc = F.concat(F.lit("<form><h1>"), F.col("doc_id").cast("string"), F.lit("</h1><p>"), t, F.lit("</p></form>"))
    rows = table(s, d, "documents", "doc_id", "text").select("doc_id", doc.alias("markup"))
    return rows.select("doc_id", F.length(D.xml_text(F.col("markup"))).alias("n_text"), F.length(D.to_markdown(F.col("markup"))).alias("n_markdown"))


# -- changes to the graph -------------------------------------------------------

_CUR = "(SELECT c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 4 <> 0)"
_NEW = f"(SELECT * FROM ({_CHANGED}) WHERE c_custkey % 2 = 0)"


def _cur(s, d):
    return table(s, d, "customer", "c_custkey", "c_mktsegment", "c_nationkey").filter("c_custkey % 4 <> 0")


def _new(s, d):
    return _changed(s, d).filter("c_custkey % 2 = 0")


@query(f"SELECT * FROM {_CUR} UNION ALL SELECT * FROM {_NEW}")
def create_node(s, d):
    return G.create_nodes(_cur(s, d), _new(s, d))


@query(f"SELECT * FROM {_CUR} UNION ALL SELECT * FROM {_NEW} n WHERE n.c_custkey NOT IN (SELECT c_custkey FROM {_CUR})")
def merge_node(s, d):
    return G.merge_nodes(_cur(s, d), _new(s, d), ["c_custkey"])


@query(f"SELECT * FROM {_NEW} UNION ALL SELECT * FROM {_CUR} c WHERE c.c_custkey NOT IN (SELECT c_custkey FROM {_NEW})")
def merge_set(s, d):
    return G.merge_set(_cur(s, d), _new(s, d), ["c_custkey"])


@query(f"SELECT c.c_custkey, CASE WHEN n.c_custkey IS NULL THEN c.c_mktsegment ELSE n.c_mktsegment END AS c_mktsegment, CASE WHEN n.c_custkey IS NULL THEN c.c_nationkey ELSE n.c_nationkey END AS c_nationkey FROM {_CUR} c LEFT JOIN {_NEW} n USING (c_custkey)")
def match_set(s, d):
    return G.match_set(_cur(s, d), _new(s, d), ["c_custkey"])


@query("SELECT DISTINCT 'HAS_ORDER' AS rel, o_custkey AS src_id, o_orderkey AS dst_id FROM orders")
def merge_edge(s, d):
    e = table(s, d, "orders", "o_custkey", "o_orderkey").select(F.lit("HAS_ORDER").alias("rel"), F.col("o_custkey").alias("src_id"), F.col("o_orderkey").alias("dst_id"))
    # Of the new edges those with an even dst_id that is no multiple of 3 are there already.
    return G.merge_edges(e.filter("NOT dst_id % 3 <=> 0"), e.filter("dst_id % 3 = 0 OR dst_id % 2 = 0"))


@query("SELECT DISTINCT p_brand, c AS radical, i AS position FROM (SELECT p_brand, unnest(regexp_extract_all(p_brand, '.')) AS c, generate_subscripts(regexp_extract_all(p_brand, '.'), 1) AS i FROM part)")
def radical_edges(s, d):
    return G.radical_edges(table(s, d, "part", "p_brand").distinct(), "p_brand", F.split("p_brand", "")).withColumn("position", F.col("position").cast("long"))


@query(f"""WITH i AS (SELECT DISTINCT item_id, root, lemma, {_FOLD.format("lemma")} AS normal FROM corpus_item WHERE corpus_id = 3 AND lemma IS NOT NULL),
r AS (SELECT DISTINCT root FROM corpus_item WHERE corpus_id = 2 AND root LIKE '%-%'), w AS (SELECT DISTINCT root, lemma, {_FOLD.format("lemma")} AS normal FROM corpus_item WHERE corpus_id = 1 AND lemma IS NOT NULL)
SELECT CASE WHEN i.root IS NULL OR i.root NOT IN (SELECT root FROM r) THEN 'failed' WHEN EXISTS (SELECT 1 FROM w WHERE w.root = i.root AND (w.lemma = i.lemma OR w.normal = i.normal OR w.normal = i.lemma OR w.lemma = i.normal)) THEN 'linked' ELSE 'created' END AS status, count(*) AS n FROM i GROUP BY 1""")
def link_or_create(s, d):
    rows = table(s, d, "corpus_item", "corpus_id", "item_id", "root", "lemma")
    def form(df):
        return df.filter("lemma IS NOT NULL").select("item_id", "root", F.col("lemma").alias("plain"), _fold(F.col("lemma")).alias("normal"))
    items = form(rows.filter("corpus_id = 3")).distinct().withColumnRenamed("item_id", "item")
    words = form(rows.filter("corpus_id = 1")).withColumnRenamed("item_id", "word")
    roots = rows.filter("corpus_id = 2").filter(F.col("root").contains("-")).select("root").distinct()
    return G.link_or_create(items, roots, words).groupBy("status").agg(_count())


@query(f"SELECT CASE WHEN c.c_custkey IS NULL THEN 'create' WHEN c.c_mktsegment IS NOT DISTINCT FROM n.c_mktsegment THEN 'skip' ELSE 'update' END AS action, count(*) AS n FROM {_NEW} n LEFT JOIN {_CUR} c USING (c_custkey) GROUP BY 1")
def root_upsert(s, d):
    return G.upsert_action(_new(s, d), _cur(s, d), "c_custkey", "c_mktsegment").groupBy("action").agg(_count())


@query("""WITH c AS (SELECT DISTINCT word, lang FROM sem_word WHERE id % 2 = 0 AND trim(word) <> ''), n AS (SELECT DISTINCT id, trim(word) AS word, lang, root FROM sem_word WHERE id % 2 = 1)
SELECT CASE WHEN n.root IS NULL THEN 'unresolved' WHEN n.word IS NULL OR n.word = '' THEN 'empty' WHEN EXISTS (SELECT 1 FROM c WHERE trim(c.word) = n.word AND c.lang = n.lang) THEN 'duplicate' ELSE 'create' END AS action, count(*) AS n FROM n GROUP BY 1""")
def word_upsert(s, d):
    rows = table(s, d, "sem_word", "id", "word", "lang", "root")
    known = rows.filter("id % 2 = 0").select(F.trim("word").alias("word"), "lang").filter("word <> ''").distinct().withColumn("dup", F.lit(True))
    new = rows.filter("id % 2 = 1").select("id", F.trim("word").alias("word"), "lang", "root").distinct().join(known, ["word", "lang"], "left")
    action = F.when(F.col("root").isNull(), "unresolved").when(F.col("word").isNull() | (F.col("word") == ""), "empty").when(F.col("dup"), "duplicate").otherwise("create")
    return new.groupBy(action.alias("action")).agg(_count())


@query("SELECT id, coalesce(max(l.lang), 'Language_' || w.lang) AS lang_name FROM (SELECT DISTINCT id, lang FROM sem_word) w LEFT JOIN (SELECT id AS lid, lang FROM sem_lang WHERE id < 5) l ON w.lang = l.lid GROUP BY id, w.lang")
def backfill(s, d):
    names = table(s, d, "sem_lang", "id", "lang").filter("id < 5").select(F.col("id").alias("lid"), F.col("lang").alias("lang_name"))
    rows = table(s, d, "sem_word", "id", "lang").distinct().join(names, F.col("lang") == F.col("lid"), "left")
    return G.backfill(rows, "lang_name", F.concat(F.lit("Language_"), F.col("lang").cast("string"))).select("id", "lang_name")


# -- batches and requests ---------------------------------------------------------


@query("SELECT (doc_id - 1) // 250 + 1 AS chunk, count(*) FILTER (WHERE n_chars >= 200) AS n_ok, count(*) FILTER (WHERE n_chars < 200) AS n_rejected FROM documents GROUP BY 1")
def fixed_chunks(s, d):
    rows = B.fixed_chunks(table(s, d, "documents", "doc_id", "n_chars"), "doc_id", 250)
    return rows.groupBy("chunk").agg(F.count_if(F.col("n_chars") >= 200).alias("n_ok"), F.count_if(F.col("n_chars") < 200).alias("n_rejected"))


@query("""WITH RECURSIVE t AS (SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS o FROM documents WHERE source IS NOT NULL),
f AS (SELECT source, o, n_chars, n_chars AS total, 1 AS bin FROM t WHERE o = 1 UNION ALL
SELECT t.source, t.o, t.n_chars, CASE WHEN f.total > 0 AND f.total + t.n_chars > 20000 THEN t.n_chars ELSE f.total + t.n_chars END, CASE WHEN f.total > 0 AND f.total + t.n_chars > 20000 THEN f.bin + 1 ELSE f.bin END FROM f JOIN t ON t.source = f.source AND t.o = f.o + 1)
SELECT source, bin, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM f GROUP BY 1, 2""")
def token_budget_bins(s, d):
    rows = table(s, d, "documents", "source", "doc_id", "n_chars").filter("source IS NOT NULL")
    return B.budget_bins(rows, "source", "doc_id", "n_chars", 20_000).groupBy("source", "bin").agg(_count(), F.sum("n_chars").alias("chars"))


@query("SELECT DISTINCT (doc_id - 1) // 100 + 1 AS chunk FROM documents WHERE ((doc_id - 1) // 100 + 1) % 3 <> 0")
def resume_manifest(s, d):
    work = B.fixed_chunks(table(s, d, "documents", "doc_id"), "doc_id", 100).select("chunk").distinct()
    return B.pending(work, work.filter("chunk % 3 = 0"), ["chunk"])


@query("SELECT word_id AS ordinal, upper(trim(english)) AS content FROM (SELECT DISTINCT word_id, english FROM word WHERE english IS NOT NULL)")
def request_roundtrip(s, d):
    w = table(s, d, "word", "word_id", "english").filter("english IS NOT NULL").distinct()
    asked = w.select(B.requests(F.concat(F.lit("request-"), F.col("word_id").cast("string")), F.lit("Translate."), F.col("english")).alias("line"))
    return B.response_rows(asked.select(B.stub_response(F.col("line")).alias("line")), "line")


@query("SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k, '' AS form FROM events")
def response_fields(s, d):
    e = table(s, d, "events", "event_id", "props")
    return e.select("event_id", *B.json_fields(F.col("props"), "k", "form"))


# -- sources and streaming ----------------------------------------------------------


@query("SELECT p_partkey, p_name, p_brand FROM part")
def csv_roundtrip(s, d):
    path = f"{scratch_root(s)}/csv-{uuid.uuid4().hex}"
    write_csv(table(s, d, "part", "p_partkey", "p_name", "p_brand"), path)
    return tolerant(read_csv(s, path, "p_partkey", "p_name", place="place"), "p_partkey", "place").drop("place")


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n_events FROM events GROUP BY ALL")
def stream_link(s, d):
    schema = table(s, d, "events").schema
    return daily_counts(s, d, schema, "events.parquet", f"stream-{uuid.uuid4().hex}")
