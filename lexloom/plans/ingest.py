"""Queries over upserts, pages, providers, readers and sinks, with the SQL that must give the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import batches as B
from ..operators import documents as D
from ..operators import graph as G
from ..operators import providers as P
from ..operators import upserts as U
from ..operators.hierarchy import resolve_hierarchy
from ..operators.latest import latest_version
from ..operators.paging import keyset_page
from ..session import scratch_root
from ..sources import readers as R
from ..sources import writers as W
from ..sources.tables import table
from .catalogue import _CHANGED, _changed, query


def _folder(s: SparkSession, name: str) -> str:
    return f"{scratch_root(s)}/{name}-{uuid.uuid4().hex}"


# -- roots and words ------------------------------------------------------------------

_SPELLED = "concat_ws('-', {})".format(", ".join(f"CASE WHEN rad{i} IS NULL THEN NULL WHEN rad{i} BETWEEN 0 AND 27 THEN '{X.ALPHABET}'[CAST(rad{i} AS INT) + 1] ELSE '?' || CAST(rad{i} AS INT) END" for i in (1, 2, 3, 4)))
_ROOTS = f"""inc AS (SELECT DISTINCT {_SPELLED} AS spelling, id AS sem_id, concept FROM sem_root WHERE concept IS NOT NULL),
cur AS (SELECT min(item_id) AS root_id, root AS spelling, CASE WHEN min(item_id) % 2 = 0 THEN (SELECT min(sem_id) FROM inc WHERE spelling = root) END AS sem_id FROM corpus_item WHERE corpus_id = 2 AND root LIKE '%-%' GROUP BY root)"""


def _incoming_roots(s, d):
    rads = ["rad1", "rad2", "rad3", "rad4"]
    rows = table(s, d, "sem_root", "id", "concept", *rads).filter("concept IS NOT NULL")
    return rows.select(X.reconstruct_root(*map(F.col, rads)).alias("spelling"), F.col("id").alias("sem_id"), "concept").distinct()


@query(f"""WITH {_ROOTS},
met AS (SELECT i.*, c.root_id, c.sem_id AS old, row_number() OVER (PARTITION BY i.spelling ORDER BY i.sem_id, i.concept) AS nth FROM inc i LEFT JOIN cur c USING (spelling)),
made AS (SELECT spelling, (SELECT max(root_id) FROM cur) + row_number() OVER (ORDER BY spelling) AS new_id FROM met WHERE root_id IS NULL AND nth = 1)
SELECT CASE WHEN root_id IS NULL THEN CASE nth WHEN 1 THEN 'create' ELSE 'update' END WHEN old = sem_id THEN 'skip' ELSE 'update' END AS action,
  coalesce(root_id, new_id) AS root_id, spelling, count(*) AS n, min(sem_id) AS least_sem_id FROM met LEFT JOIN made USING (spelling) GROUP BY 1, 2, 3""")
def upsert_roots(s, d):
    incoming = _incoming_roots(s, d)
    items = table(s, d, "corpus_item", "corpus_id", "item_id", "root").filter("corpus_id = 2").filter(F.col("root").contains("-"))
    least = incoming.groupBy("spelling").agg(F.min("sem_id").alias("sem_id"))
    current = items.groupBy(F.col("root").alias("spelling")).agg(F.min("item_id").alias("root_id")).join(least, "spelling", "left")
    current = current.select("root_id", "spelling", F.when(F.col("root_id") % 2 == 0, F.col("sem_id")).alias("sem_id"))
    done = U.upsert_roots(incoming, current, "spelling", "sem_id", "root_id", "concept")
    return done.groupBy("action", "root_id", "spelling").agg(F.count("*").alias("n"), F.min("sem_id").alias("least_sem_id"))


_WORDS = """inc AS (SELECT DISTINCT id, word, lang, root, nullif(trim(root_lang), '') AS script FROM sem_word WHERE id % 2 = 1),
cur AS (SELECT word, lang, root, nullif(trim(root_lang), '') AS script FROM sem_word WHERE id % 2 = 0),
there AS (SELECT trim(word) AS w, lang AS l, root AS r, count(script) AS scripts FROM cur GROUP BY 1, 2, 3),
judged AS (SELECT i.*, CASE WHEN i.root IS NULL THEN 'unresolved' WHEN coalesce(trim(word), '') = '' THEN 'empty' WHEN scripts = 0 THEN 'update'
  WHEN w IS NOT NULL OR row_number() OVER (PARTITION BY trim(word), lang, root ORDER BY script NULLS LAST, id) > 1 THEN 'skip'
  WHEN root NOT IN (SELECT id FROM sem_root) THEN 'create_root' ELSE 'create' END AS action
  FROM inc i LEFT JOIN there ON trim(word) = w AND lang = l AND root = r)"""


def _judged(s, d):
    rows = table(s, d, "sem_word", "id", "word", "lang", "root", "root_lang").select("id", "word", "lang", "root", F.nullif(F.trim("root_lang"), F.lit("")).alias("script"))
    roots = table(s, d, "sem_root", "id").select(F.col("id").alias("root"))
    return U.upsert_words(rows.filter("id % 2 = 1").distinct(), rows.filter("id % 2 = 0"), roots, "word", "lang", "root", "script")


@query(f"WITH {_WORDS} SELECT lang, action, count(*) AS n FROM judged GROUP BY 1, 2")
def upsert_words(s, d):
    return _judged(s, d).groupBy("lang", "action").agg(F.count("*").alias("n"))


@query(f"WITH {_WORDS} SELECT 'BELONGS_TO_ROOT' AS rel, root AS dst_id, count(*) AS n FROM judged WHERE action LIKE 'create%' GROUP BY root")
def word_edges(s, d):
    return U.word_edges(_judged(s, d), F.struct("word", "lang"), "root").groupBy("rel", "dst_id").agg(F.count("*").alias("n"))


@query("""WITH RECURSIVE cur AS (SELECT id, v.root AS root, CASE WHEN regexp_matches(coalesce(v.root_lang, ''), '\\S') THEN v.root END AS parent
  FROM (SELECT id, arg_max({'root': root, 'root_lang': root_lang}, loaded_at) AS v FROM sem_word WHERE id IS NOT NULL GROUP BY id)),
down AS (SELECT id, root FROM cur WHERE parent IS NULL UNION ALL SELECT c.id, d.root FROM cur c JOIN down d ON c.parent = d.id)
SELECT c.id, d.root AS resolved FROM cur c LEFT JOIN down d USING (id)""")
def parent_resolve_all(s, d):
    """Parents followed to the topmost word; null where there is none, or a loop."""
    words = latest_version(table(s, d, "sem_word", "id", "root", "root_lang", "loaded_at"), "id", "loaded_at", "root", "root_lang")
    derived = F.coalesce(F.col("root_lang").rlike(r"\S"), F.lit(False)) & F.col("root").isNotNull()
    links = words.select("id", F.when(derived, F.col("root")).alias("parent"), F.when(~derived, F.col("root")).alias("own"))
    tops = resolve_hierarchy(links, "id", "parent").select("id", F.when(F.col("tree_depth") >= 0, F.col("top_id")).alias("top"))
    return tops.join(links.select(F.col("id").alias("top"), "own"), "top", "left").select("id", F.col("own").alias("resolved"))


_BULK = f"(SELECT * FROM ({_CHANGED}) WHERE c_custkey % 2 = 0)"


@query(f"SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN 'updated' ELSE 'failed' END AS status FROM {_BULK}")
def bulk_update(s, d):
    current = table(s, d, "customer", "c_custkey", "c_mktsegment", "c_nationkey").filter("c_custkey % 4 <> 0")
    return G.bulk_update(current, _changed(s, d).filter("c_custkey % 2 = 0"), ["c_custkey"])[1]


@query("SELECT DISTINCT c AS radical, i AS position FROM (SELECT unnest(regexp_extract_all(p_brand, '.')) AS c, generate_subscripts(regexp_extract_all(p_brand, '.'), 1) AS i FROM part)")
def radical_nodes(s, d):
    edges = G.radical_edges(table(s, d, "part", "p_brand").distinct(), "p_brand", F.split("p_brand", ""))
    return G.radical_nodes(edges).withColumn("position", F.col("position").cast("long"))


@query("""SELECT i.item_id AS item, CASE WHEN i.root IS NULL THEN 'no root' ELSE 'root not found' END AS reason FROM (SELECT DISTINCT item_id, root, lemma FROM corpus_item WHERE corpus_id = 3 AND lemma IS NOT NULL) i
WHERE i.root IS NULL OR i.root NOT IN (SELECT root FROM corpus_item WHERE corpus_id = 2 AND root LIKE '%-%')""")
def link_failures(s, d):
    rows = table(s, d, "corpus_item", "corpus_id", "item_id", "root", "lemma").filter("lemma IS NOT NULL OR corpus_id = 2")
    plain = F.col("lemma").alias("plain"), F.col("lemma").alias("normal")
    items = rows.filter("corpus_id = 3").select(F.col("item_id").alias("item"), "root", *plain).distinct()
    words = rows.filter("corpus_id = 1").select(F.col("item_id").alias("word"), "root", *plain)
    roots = rows.filter("corpus_id = 2").filter(F.col("root").contains("-")).select("root").distinct()
    return G.link_or_create(items, roots, words).filter("status = 'failed'").select("item", "reason")


@query(f"SELECT o.c_custkey, 'c_nationkey' AS property, CAST(o.c_nationkey AS VARCHAR) AS old_value, CAST(n.c_nationkey AS VARCHAR) AS new_value FROM customer o JOIN ({_CHANGED}) n USING (c_custkey) WHERE n.c_nationkey IS NOT NULL AND o.c_nationkey IS DISTINCT FROM n.c_nationkey UNION ALL SELECT o.c_custkey, 'c_mktsegment', o.c_mktsegment, n.c_mktsegment FROM customer o JOIN ({_CHANGED}) n USING (c_custkey) WHERE n.c_mktsegment IS NOT NULL AND o.c_mktsegment IS DISTINCT FROM n.c_mktsegment")
def property_diff_values(s, d):
    return G.property_diff(table(s, d, "customer"), _changed(s, d), "c_custkey", ["c_mktsegment", "c_nationkey"], drop_nulls=True)


# -- joins and pages --------------------------------------------------------------------


@query("SELECT d.doc_id, d.root_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM sem_root r WHERE r.id = d.root_id)")
def lookup_unmatched(s, d):
    roots = table(s, d, "sem_root", "id").withColumnRenamed("id", "root_id")
    return table(s, d, "documents", "doc_id", "root_id").join(roots, "root_id", "left_anti").select("doc_id", "root_id")


@query("SELECT o.o_orderkey, c.l_partkey FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 10) o LEFT JOIN (SELECT l_orderkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem) WHERE n <= 3) c ON o.o_orderkey = c.l_orderkey")
def first_parents(s, d):
    """The first ten parents, each with its first three children."""
    parents = keyset_page(table(s, d, "orders", "o_orderkey"), "o_orderkey", 10)
    lines = table(s, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(parents, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    first = lines.groupBy("l_orderkey").agg(F.slice(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), 1, 3).alias("c"))
    return parents.join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.explode_outer("c").alias("c")).select("o_orderkey", "c.l_partkey")


@query("SELECT form_id, count(*) AS n FROM (SELECT CASE form WHEN 'I' THEN 1 WHEN 'II' THEN 2 WHEN 'III' THEN 3 WHEN 'IV' THEN 4 END AS form_id FROM word) WHERE form_id IS NOT NULL GROUP BY 1")
def dictionary_hits(s, d):
    found = X.lookup(F.col("form"), {"I": "1", "II": "2", "III": "3", "IV": "4"}).cast("int")
    return table(s, d, "word", "form").select(found.alias("form_id")).filter("form_id IS NOT NULL").groupBy("form_id").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey > 200 ORDER BY c_custkey LIMIT 50")
def keyset_pages(s, d):
    return keyset_page(table(s, d, "customer", "c_custkey", "c_name"), "c_custkey", 50, after=200)


# -- batches and providers --------------------------------------------------------------


@query("SELECT (c_custkey - 1) // 500 + 1 AS chunk, count(*) AS n, min(c_custkey) AS first, max(c_custkey) AS last FROM customer GROUP BY 1")
def update_chunks(s, d):
    return B.chunk_groups(table(s, d, "customer", "c_custkey"), "c_custkey")


@query("SELECT DISTINCT (doc_id - 1) // 100 + 1 AS chunk FROM documents WHERE (doc_id - 1) // 100 + 1 > 3")
def resume_outputs(s, d):
    """The chunks of which no output lies in the folder yet."""
    out = _folder(s, "outputs")
    W.write_files(s.createDataFrame([(f"batch_{i}.jsonl", "{}") for i in (1, 2, 3)] + [("batch_x.jsonl", "{}")], "name string, body string"), "name", "body", out)
    work = B.fixed_chunks(table(s, d, "documents", "doc_id"), "doc_id", 100).select("chunk").distinct()
    return B.pending(work, B.finished(s, out, "batch_{}.jsonl"), ["chunk"])


@query("SELECT word_id, english, upper(english) AS answer FROM (SELECT DISTINCT word_id, english, arabic FROM word WHERE english IS NOT NULL AND trim(english) = english AND english <> '' AND NOT contains(english, ' | '))")
def provider_roundtrip(s, d):
    """Requests built, sent in batches to a provider, answers joined back by the number in their id."""
    w = table(s, d, "word", "word_id", "english", "arabic").filter((F.trim("english") == F.col("english")) & (F.col("english") != "") & ~F.col("english").contains(" | ")).distinct()
    prompts = {"meaning": ("Give the meaning.", ("arabic", "english"))}
    answers = P.submit(P.prompt_requests(w, "meaning", "word_id", prompts=prompts), "line", P.StubProvider, size=500, poll=0.0)
    return w.join(B.response_rows(answers, "line"), F.col("word_id") == F.col("ordinal")).select("word_id", "english", F.col("content").alias("answer"))


# -- markup ------------------------------------------------------------------------------


@query("SELECT p_partkey, 'n' || p_partkey AS id, p_brand AS key, '' AS type, p_type || '; ' || p_name AS forms, p_type || '; ' || p_name || '; ' || p_size AS texts FROM part")
def xml_entries(s, d):
    def tag(name, c):
        return F.concat(F.lit(f"<{name}> "), c, F.lit(f" </{name}>"))

    form = tag("form", F.concat(tag("orth", F.col("p_type")), tag("orth", F.col("p_name"))))
    start = F.concat(F.lit('<entry id="n'), F.col("p_partkey").cast("string"), F.lit('" key="'), F.col("p_brand"), F.lit('">'))
    rows = table(s, d, "part", "p_partkey", "p_brand", "p_type", "p_name", "p_size")
    markup = F.concat(start, form, tag("sense", F.col("p_size").cast("string")), F.lit("</entry>"))
    return rows.select("p_partkey", D.xml_entry(markup).alias("e")).select("p_partkey", "e.*")


@query("SELECT n_regionkey AS file, dense_rank() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS chapter_no, n_name AS chapter, CASE k WHEN 1 THEN 'part one' WHEN 2 THEN 'part two or three' END AS section, n_name || CASE k WHEN 1 THEN '/part one' WHEN 2 THEN '/part two or three' ELSE '' END AS path FROM nation, range(3) r(k)")
def contents_tree(s, d):
    lines = F.array(F.struct(F.lit(0).alias("k"), F.col("n_name").alias("line")), F.struct(F.lit(1).alias("k"), F.lit("- part, one").alias("line")), F.struct(F.lit(2).alias("k"), F.lit("-part two/three").alias("line")))
    rows = table(s, d, "nation", "n_nationkey", "n_regionkey", "n_name").select(F.col("n_regionkey").alias("file"), "n_nationkey", F.explode(lines).alias("x"))
    return D.contents_rows(rows.select("file", F.struct("n_nationkey", "x.k").alias("o"), "x.line"), "o", "line", "file").withColumn("chapter_no", F.col("chapter_no").cast("long"))


# -- files ---------------------------------------------------------------------------------


@query("SELECT s_suppkey AS id, s_name || ', \"q\"' AS word FROM supplier")
def csv_with_mark(s, d):
    path = _folder(s, "bom") + "/one.csv"
    rows = table(s, d, "supplier", "s_suppkey", "s_name").select(F.col("s_suppkey").alias("id"), F.concat("s_name", F.lit(', "q"')).alias("word"))
    W.single(rows, path, bom=True)
    return R.tolerant(R.read_csv(s, path, "id", "word", place="place"), "id", "place").select("id", "word")


@query("SELECT row_number() OVER (ORDER BY s_suppkey) AS ordinal, CAST(s_suppkey AS INT) AS id, s_name AS form FROM supplier")
def tsv_with_preamble(s, d):
    path = _folder(s, "tsv")
    lines = table(s, d, "supplier", "s_suppkey", "s_name").select("s_suppkey", F.concat_ws("\t", F.col("s_suppkey").cast("string"), "s_name").alias("line"))
    head = s.createDataFrame([(-3, "# made by hand"), (-2, "# two lines"), (-1, "ID\tFORM")], "s_suppkey long, line string")
    lines.unionByName(head).coalesce(1).sortWithinPartitions("s_suppkey").select("line").write.text(path)
    return R.read_preamble_tsv(s, path, 2, "id int, form string")


@query("SELECT n_regionkey + 1 AS file_no, n_name AS name FROM nation WHERE n_regionkey <> 2")
def numbered_lines(s, d):
    """JSON lines in numbered files of which one is missing."""
    folder = _folder(s, "numbered")
    rows = table(s, d, "nation", "n_regionkey", "n_name").filter("n_regionkey <> 2").select((F.col("n_regionkey") + 1).alias("i"), F.to_json(F.struct("n_name")).alias("line"))
    files = rows.groupBy("i").agg(F.concat_ws("\n", F.collect_list("line")).alias("body")).select(F.format_string("out_%d.jsonl", F.col("i").cast("int")).alias("name"), "body")
    W.write_files(files, "name", "body", folder)
    lines = R.read_numbered(s, folder + "/out_{}.jsonl", 5, skip_missing=True)
    return lines.select(F.col("file_no").cast("long").alias("file_no"), F.get_json_object("line", "$.n_name").alias("name"))


@query("SELECT r_name || '.txt' AS file_name, 2 * row_number() OVER (PARTITION BY r_name ORDER BY n_name) AS line_number, n_name AS line FROM nation JOIN region ON n_regionkey = r_regionkey")
def line_files(s, d):
    """Text files with blank lines between, one a region; also the sink of one file a row."""
    folder = _folder(s, "lines")
    rows = table(s, d, "nation", "n_regionkey", "n_name").join(table(s, d, "region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    body = F.concat(F.lit("\n"), F.concat_ws("\n \n", F.array_sort(F.collect_list(F.concat(F.lit("  "), "n_name")))))
    W.write_files(rows.groupBy("r_name").agg(body.alias("body")).withColumn("name", F.concat("r_name", F.lit(".txt"))), "name", "body", folder)
    return R.read_lines(s, folder).withColumn("file_name", F.replace(F.col("file_name"), F.lit("%20"), F.lit(" ")))


@query("SELECT CAST(n_regionkey AS INT) AS sura_index, r_name AS sura_name, CAST(n_nationkey AS INT) AS aya_index, n_name AS text FROM nation JOIN region ON n_regionkey = r_regionkey")
def verse_files(s, d):
    folder = _folder(s, "verses")
    rows = table(s, d, "nation", "n_nationkey", "n_regionkey", "n_name").join(table(s, d, "region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    ayas = F.concat_ws("", F.collect_list(F.format_string('<aya index="%s" text="%s"/>', F.col("n_nationkey").cast("string"), F.col("n_name"))))
    suras = rows.groupBy("n_regionkey", "r_name").agg(ayas.alias("a")).select(F.format_string('<quran><sura index="%s" name="%s">%s</sura></quran>', F.col("n_regionkey").cast("string"), "r_name", "a").alias("body"), F.format_string("%s.xml", F.col("n_regionkey").cast("string")).alias("name"))
    W.write_files(suras, "name", "body", folder)
    return R.read_verses(s, folder)


@query("SELECT p_partkey AS id, p_brand AS brand FROM part")
def keyed_json(s, d):
    """A JSON array in which every id occurs twice; the last counts."""
    folder = _folder(s, "keyed")
    p = table(s, d, "part", "p_partkey", "p_brand")
    one = F.to_json(F.struct(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand")))
    old = F.to_json(F.struct(F.col("p_partkey").alias("id"), F.lit("old").alias("brand")))
    parts = p.groupBy((F.col("p_partkey") % 4).alias("f")).agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(F.concat(old, F.lit(","), one))), F.lit("]")).alias("body"))
    W.write_files(parts.withColumn("name", F.concat(F.col("f").cast("string"), F.lit(".json"))), "name", "body", folder)
    return R.read_keyed_json(s, folder, "id long, brand string")


@query("SELECT participants, msg_id, sender_name FROM fb_jsons WHERE participants LIKE '[{%}]' AND sender_name IS NOT NULL")
def conversation_files(s, d):
    """Conversations written as JSON files, one a row, and read again."""
    folder = _folder(s, "conversations")
    rows = table(s, d, "fb_jsons", "msg_id", "participants", "sender_name").filter(F.col("participants").like("[{%}]") & F.col("sender_name").isNotNull())
    message = F.struct("sender_name", F.col("msg_id").alias("timestamp_ms"), F.col("participants").alias("content"))
    parsed = F.from_json("participants", "array<struct<name:string>>")
    rows.select(parsed.alias("participants"), F.array(message).alias("messages")).filter("participants IS NOT NULL").write.json(folder)
    # Each line is a file's content of its own.
    back = s.read.schema(R.CONVERSATION).json(folder).filter("participants IS NOT NULL")
    return back.select(F.explode("messages").alias("m")).select(F.col("m.content").alias("participants"), F.col("m.timestamp_ms").alias("msg_id"), "m.sender_name")


@query("SELECT 3 AS step, '/_bulk' AS path, count(*) AS n FROM nation UNION ALL SELECT 1, '/nations?ignore_unavailable=true', 1 UNION ALL SELECT 2, '/nations', 1")
def index_requests(s, d):
    rows = W.index_requests(table(s, d, "nation", "n_nationkey", "n_name"), "nations", F.col("n_nationkey"), recreate=True)
    return rows.groupBy("step", "path").agg(F.count("*").alias("n"))


@query("SELECT doc_id FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL")
def complete_rows(s, d):
    return R.dropna(table(s, d, "documents", "doc_id", "lang", "source"), "lang", "source").select("doc_id")


@query("SELECT a.p_partkey, f AS field, CASE f WHEN 'p_brand' THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS left_value, CASE f WHEN 'p_brand' THEN lower(p_brand) ELSE CAST(p_size + 1 AS VARCHAR) END AS right_value FROM part a, (VALUES ('p_brand'), ('p_size')) v(f) WHERE a.p_partkey % 3 <> 0 AND (f = 'p_size' AND a.p_partkey % 5 = 0 OR f = 'p_brand' AND a.p_partkey % 7 = 0)")
def deep_diff(s, d):
    """Two versions of a table compared field by field."""
    left = table(s, d, "part", "p_partkey", "p_brand", "p_size").withColumn("tags", F.array("p_brand", F.lit("x")))
    k = F.col("p_partkey")
    right = left.filter(k % 3 != 0).select("p_partkey", F.when(k % 7 == 0, F.lower("p_brand")).otherwise(F.col("p_brand")).alias("p_brand"), F.when(k % 5 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("p_size"), F.reverse("tags").alias("tags"))
    return D.deep_diff(left, right, "p_partkey")
