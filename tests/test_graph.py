from pyspark.sql import functions as F

from lexloom.operators import batches as B
from lexloom.operators import documents as D
from lexloom.operators import graph as G
from lexloom.operators.fuzzy import fuzzy_nearest
from lexloom.operators.numbering import number_rows, number_within

CUR, NEW = [(1, "a", 1), (2, "b", 2)], [(2, "B", 5, None), (2, "BB", 6, None), (3, "c", 7, 3)]


def frames(spark):
    return spark.createDataFrame(CUR, "id long, name string, n int"), spark.createDataFrame(NEW, "id long, name string, o int, n int")


def rows(df):
    return sorted(map(tuple, df.select("id", "name", "n").collect()))


def test_merges(spark):
    cur, new = frames(spark)
    assert rows(G.merge_nodes(cur, new, ["id"], "o")) == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]
    merged = G.merge_set(cur, new, ["id"], "o")
    assert rows(merged) == [(1, "a", 1), (2, "BB", None), (3, "c", 3)]
    assert rows(G.merge_set(merged, new, ["id"], "o")) == rows(merged)
    assert rows(G.match_set(cur, new, ["id"], "o")) == [(1, "a", 1), (2, "BB", None)]
    assert rows(G.merge_set(cur.limit(0), new, ["id"], "o")) == [(2, "BB", None), (3, "c", 3)]
    assert G.property_diff(cur, cur, "id", ["name", "n"]).count() == 0


def test_link_or_create_groups_new_words(spark):
    items = spark.createDataFrame([(1, "r", "أ", "ا"), (2, "r", "ا", "ا"), (3, "r", "kk", "kk"), (4, None, "x", "x"), (5, "zz", "x", "x")], "item int, root string, plain string, normal string")
    roots = spark.createDataFrame([("r",), ("r",)], "root string")
    words = spark.createDataFrame([("r", "kk", "kk", 9), ("r", "kk", "kk", 8)], "root string, plain string, normal string, word int")
    got = {r["item"]: (r["status"], r["word_key"]) for r in G.link_or_create(items, roots, words).collect()}
    assert got == {1: ("created", "r|ا"), 2: ("created", "r|ا"), 3: ("linked", "8"), 4: ("failed", None), 5: ("failed", None)}


def test_numbers_are_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = {r.k: r.ordinal for r in number_rows(df, ["k"], parts=7).collect()}
    assert got == {k: k + 1 for k in range(1000)}
    assert number_rows(df.limit(0), ["k"]).count() == 0


def test_fuzzy_against_brute_force(spark):
    def lev(a, b):
        p = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            q = [i]
            for j, y in enumerate(b, 1):
                q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
            p = q
        return p[-1]

    words = ["كتاب", "كتب", "قلم", "bowl", "bow", "a"]
    tokens = ["كتابه", "كتاب", "قلب", "bawl", "zzzzz", "", "ab", None]
    lex = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, o int")
    got = {r["token"]: (r["word"], r["distance"]) for r in fuzzy_nearest(spark.createDataFrame([(t,) for t in tokens], "token string"), "token", lex, "word", "o").collect()}
    want = {}
    for t in tokens:
        if t is not None:
            d, i = min((lev(t, w), i) for i, w in enumerate(words))
            if d <= 2:
                want[t] = (words[i], d)
    assert got == want


def test_bins_and_oversize(spark):
    df = spark.createDataFrame([("a", i, c) for i, c in enumerate([5, 5, 1, 50, 2, 9])], "g string, o long, c long")
    got = [r.bin for r in sorted(B.budget_bins(df, "g", "o", "c", 10).collect(), key=lambda r: r.o)]
    assert got == [1, 1, 2, 3, 4, 5]


def test_requests_and_malformed_answers(spark):
    df = spark.createDataFrame([(1, "héllo")], "n int, t string")
    asked = df.select(B.requests(F.concat(F.lit("request-"), F.col("n").cast("string")), F.lit("s"), F.col("t")).alias("line"))
    answers = asked.select(B.stub_response(F.col("line")).alias("line")).union(spark.createDataFrame([("{broken",), (None,)], "line string"))
    assert [tuple(r) for r in B.response_rows(answers, "line").collect()] == [(1, "HÉLLO")]
    fields = spark.createDataFrame([('{"a": "x"}',), ("no",)], "c string").select(*B.json_fields(F.col("c"), "a", "b")).collect()
    assert [tuple(r) for r in fields] == [("x", ""), (None, None)]


def test_documents(spark):
    df = spark.createDataFrame([("<a><b> x </b>y<c/></a>",), ("<broken",), (None,)], "m string")
    assert [r[0] for r in df.select(D.xml_text(F.col("m"))).collect()] == ["x; y", None, None]
    html = spark.createDataFrame([("<h2>T</h2><p>a <b>b</b> <a href='u'>l</a></p>",)], "h string")
    assert html.select(D.to_markdown(F.col("h"))).first()[0] == "## T\n\na **b** [l](u)"
    flat = D.flatten_mapping({"properties": {"a": {"type": "text", "fields": {"k": {"type": "keyword", "n": 1}}}, "o": {"properties": {"x": {"type": "long"}}}}})
    assert flat == [("a", "text", "{}"), ("a.k", "keyword", '{"n": 1}'), ("o", "n/a", "{}"), ("o.x", "long", "{}")]
    a = spark.createDataFrame([(1, "x", [1, 2]), (2, "y", [3])], "id int, s string, l array<int>")
    b = spark.createDataFrame([(1, "x", [2, 1]), (2, "z", [3]), (9, "q", [1])], "id int, s string, l array<int>")
    assert [tuple(r) for r in D.deep_diff(a, b, "id").collect()] == [(2, "s", "y", "z")]


def test_numbers_within_a_hot_group(spark):
    df = spark.range(600).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 9).cast("string"))).alias("g"), "id")
    got = number_within(df, ["g"], ["id"]).collect()
    for g in {r.g for r in got}:
        own = sorted((r.id, r.n) for r in got if r.g == g)
        assert [n for _, n in own] == list(range(1, len(own) + 1))
