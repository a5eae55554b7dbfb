"""Queries over small tables of their own, against plain Python."""

import re

from lexloom.functions import text as X
from lexloom.plans.catalogue import QUERIES


def tables(spark, folder, **frames):
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def result(spark, d, name):
    return [tuple(r) for r in QUERIES[name](spark, d).collect()]


def test_article_strip_takes_words_with_marks(spark, tmp_path):
    def bare(w):
        w = re.sub("^[اٱ]?ل(?=.{2})", "", w)
        w = re.sub("^\u0651", "", re.sub(f"^{X.WIDE_MARKS}{{1,2}}", "", w))
        return re.sub(f"{X.WIDE_MARKS}$", "", w)

    given = ["الاِنْشِتَان", "التَهْنِيط", "ٱلرَّحْمَنُ", "الَّذِي", "كِتَابٌ", "قلم", "لك", "الباب", "الل\nيل", "ال\u064e\u064f\u0651يل"]
    d = tables(spark, tmp_path, word=([(w,) for w in [*given, None, given[0]]], "arabic string"))
    got = result(spark, d, "article_strip")
    assert sorted(got) == sorted((w, bare(w)) for w in given)
    assert ("ٱلرَّحْمَنُ", "رَّحْمَن") in got and ("الَّذِي", "ذِي") in got and ("ال\u064e\u064f\u0651يل", "يل") in got


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_nearest_takes_whole_words(spark, tmp_path):
    english = ["vow; jar", "Threading a needle", "stitching", "NA", None, "café, scattering", "scatterings of grain"]
    names = [(1, "new hot rod"), (2, "Gear caffe ox"), (3, "unthreading stitching"), (4, "scattering needles"), (5, None), (6, "rod")]
    d = tables(spark, tmp_path, word=([(e,) for e in english], "english string"), part=(names, "p_partkey long, p_name string"))
    tokens = {t for e in english if e and e != "NA" for t in re.findall(r"[^\W\d_]+", e.lower())}
    lexicon = {}
    for o, n in names:
        for w in (n or "").lower().split():
            lexicon[w] = min(o, lexicon.get(w, o))
    want = []
    for t in tokens:
        n, _, w = min((distance(t, w), o, w) for w, o in lexicon.items())
        if n <= 2:
            want.append((t, w, n))
    got = result(spark, d, "fuzzy_nearest_words")
    assert sorted(got) == sorted(want)
    assert {("vow", "hot", 2), ("jar", "gear", 2), ("threading", "unthreading", 2), ("scatterings", "scattering", 1)} <= set(got)


def test_buckwalter_takes_the_whole_alphabet(spark, tmp_path):
    lemmas = [">mED", ">*ft", "kitAb", "sa'ala", "mu&min", "|mana", "<ilay", "bi}r", "{som", "r_Hm`n", *X.BUCKWALTER]
    others = ["قلم", "muzāšaṯah", "cf. reef?", "ktb\n", "", None]
    d = tables(spark, tmp_path, corpus_item=([(x,) for x in lemmas + others + lemmas[:2]], "lemma string"))
    table = str.maketrans(X.BUCKWALTER, X.ARABIC)
    assert sorted(result(spark, d, "buckwalter")) == sorted((x, x.translate(table)) for x in lemmas)


def test_merge_edge_inserts_and_keeps(spark, tmp_path, monkeypatch):
    d = tables(spark, tmp_path, orders=([(i % 4, i) for i in range(1, 25)] + [(1, 1), (9, None)], "o_custkey long, o_orderkey long"))
    want = sorted([("HAS_ORDER", i % 4, i) for i in range(1, 25)] + [("HAS_ORDER", 9, None)], key=str)
    assert sorted(result(spark, d, "merge_edge"), key=str) == want
    parts = []
    monkeypatch.setattr("lexloom.operators.graph.merge_edges", lambda current, new: parts.extend([set(map(tuple, x.collect())) for x in (current, new)]) or current)
    QUERIES["merge_edge"](spark, d)
    current, new = parts
    assert new - current and new & current and current - new


def test_collect_positions_keeps_corpora_apart(spark, tmp_path):
    rows = [(c, i, 1, i % 2) for c in (1, 2, 3) for i in range(c, 12)]
    d = tables(spark, tmp_path, corpus_item=(rows + rows[:3], "corpus_id int, item_id long, sura_index int, aya_index int"))
    want = []
    for c in (1, 2, 3):
        for a in (0, 1):
            ids = [i for i in range(c, 12) if i % 2 == a]
            want.append((c, 1, a, len(ids), ",".join(map(str, ids))))
    assert sorted(result(spark, d, "collect_positions")) == want
