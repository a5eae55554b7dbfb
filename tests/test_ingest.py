import random

import pytest
from pyspark.sql import functions as F

from lexloom.operators import batches as B
from lexloom.operators import graph as G
from lexloom.operators import providers as P
from lexloom.operators import upserts as U
from lexloom.operators.paging import pages
from lexloom.session import release, scratch_root, stage, unstage
from lexloom.sources import writers as W


def greedy(costs, most):
    out, b, total = [], 1, 0
    for c in costs:
        if total and total + c > most:
            b, total = b + 1, 0
        total += c
        out.append(b)
    return out


@pytest.mark.parametrize("batch", [3, 1000])
def test_budget_bins_as_a_fold(spark, batch):
    rng = random.Random(batch)
    given = {g: [rng.choice([0, 0, 1, 4, 7, 12, 30]) for _ in range(40)] for g in "abc"} | {"d": [0, 0, 50, 0, 1], "e": [10, 10]}
    rows = [(g, i, c, "x") for g, costs in given.items() for i, c in enumerate(costs)] + [(None, 1, 5, "x"), ("e", 9, None, "x")]
    df = spark.createDataFrame(rows, "g string, i long, c long, bin string")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = {}
        for r in sorted(B.budget_bins(df, "g", "i", "c", 20).collect(), key=lambda r: (r.g, r.i)):
            got.setdefault(r.g, []).append(r.bin)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == {g: greedy([*costs, *([0] if g == "e" else [])], 20) for g, costs in given.items()}


def test_batches_wait_and_fail_in_bounds():
    slept = []
    assert [P.run_batch(P.StubProvider(3), ['{"custom_id": "r-1", "body": {"messages": [{"content": "a | b"}]}}'], 60, 3600, slept.append)] != [[]] and slept == [60, 60, 60]
    for end in ("failed", "cancelled", "expired", "something new"):
        with pytest.raises(P.BatchFailed, match=end):
            P.run_batch(P.StubProvider(0, end), [], 1, 10, slept.append)
    with pytest.raises(P.BatchFailed, match="still in_progress after 120 s"):
        P.run_batch(P.StubProvider(10**6), [], 60, 100, slept.append)
    tries = []

    def shaky():
        tries.append(1)
        if len(tries) < 3:
            raise ConnectionError
        return "ok"

    assert P.retry(shaky, 3, 1, lambda s: None) == "ok" and len(tries) == 3
    with pytest.raises(ConnectionError):
        P.retry(lambda: (_ for _ in ()).throw(ConnectionError()), 2, 1, lambda s: None)


def test_every_prompt_makes_requests(spark):
    df = spark.createDataFrame([(7, "كتب", "ك-ت-ب", 1, 2, "l", None)], "id long, arabic string, root string, sura_index int, aya_index int, line string, entry string")
    for name in P.PROMPTS:
        line = P.prompt_requests(df, name, "id").first().line
        assert '"custom_id":"request-7"' in line and "كتب" in line
    assert P.submit(P.prompt_requests(df.limit(0), "roots", "id"), "line", P.StubProvider, poll=0).count() == 0


def test_root_upserts(spark):
    current = spark.createDataFrame([(5, "a-b", 1), (6, "c-d", None), (6, "c-d", 8)], "root_id long, spelling string, sem_id long")
    new = spark.createDataFrame([("a-b", 1, "x", 0), ("a-b", 2, "y", 0), ("c-d", 3, None, 0), ("n-n", 9, "z", 0), ("n-n", 4, "w", 0), ("m-m", None, "v", 0), (None, 7, "u", 0)], "spelling string, sem_id long, concept string, _s int")
    got = sorted(tuple(r) for r in U.upsert_roots(new, current, "spelling", "sem_id", "root_id", "concept").fillna(0, ["sem_id"]).fillna("", ["concept"]).collect())
    assert got == sorted([(5, "a-b", 1, "x", "skip"), (5, "a-b", 2, "y", "update"), (6, "c-d", 3, "", "update"), (7, "m-m", 0, "v", "create"), (8, "n-n", 4, "w", "create"), (8, "n-n", 9, "z", "update")])
    made = U.upsert_roots(new, current.limit(0), "spelling", "sem_id", "root_id").filter("action = 'create'")
    assert sorted(r.root_id for r in made.collect()) == [1, 2, 3, 4]
    assert U.upsert_roots(new.limit(0), current, "spelling", "sem_id", "root_id").count() == 0


def test_word_upserts(spark):
    schema = "word string, lang int, root long, script string, action string"
    current = spark.createDataFrame([("bare", 1, 10, None, ""), ("full", 1, 10, "he", "")], schema)
    new = spark.createDataFrame([(" bare ", 1, 10, "ar", "q"), ("full", 1, 10, "ar", "q"), ("full", 2, 10, "ar", "q"), ("new", 1, 99, "ar", "q"), ("new", 1, 99, "ar", "q"), (None, 1, 10, "ar", "q"), (" ", 1, 10, "ar", "q"), ("w", 1, None, "ar", "q")], schema).drop("action")
    roots = spark.createDataFrame([(10,), (10,), (None,)], "root long")
    judged = U.upsert_words(new, current.drop("action"), roots, "word", "lang", "root", "script")
    got = sorted((r.word or "", r.lang, r.action) for r in judged.collect())
    assert got == sorted([(" bare ", 1, "update"), ("full", 1, "skip"), ("full", 2, "create"), ("new", 1, "create_root"), ("new", 1, "skip"), ("", 1, "empty"), (" ", 1, "empty"), ("w", 1, "unresolved")])
    assert sorted(r.dst_id for r in U.word_edges(judged, F.col("word"), "root").collect()) == [10, 99]


def test_bulk_updates_name_what_failed(spark):
    current = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    changes = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "n")], "k long, v string")
    after, status = G.bulk_update(current, changes, ["k"])
    assert sorted((r.k or 0, r.v) for r in after.collect()) == [(0, "c"), (1, "y"), (2, "b")]
    assert sorted((r.k or 0, r.status) for r in status.collect()) == [(0, "failed"), (1, "updated"), (3, "failed")]


def test_pages_and_index_requests(spark):
    df = spark.createDataFrame([(i, f"n{i}") for i in (4, 9, 1, 7, 2)] + [(None, "x")], "id long, t string")
    assert [[r.id for r in p.collect()] for p in pages(df, "id", 2)] == [[1, 2], [4, 7], [9]]
    assert list(pages(df.limit(0), "id", 2)) == []
    steps = [(r.step, r.method) for r in W.index_requests(df, "ix", F.md5("t"), recreate=False).collect()]
    assert steps[:2] == [(1, "HEAD"), (2, "PUT")] and steps[2:] == [(3, "POST")] * 6


def test_staged_tables_can_be_removed(spark, tmp_path):
    df = stage(spark.range(5), "five")
    assert df.count() == 5
    files = df.inputFiles()
    unstage(df)
    import os

    assert not any(os.path.exists(f.removeprefix("file://")) for f in files) and scratch_root(spark)
    again = [stage(spark.range(5), "again") for _ in range(2)]
    files = [f for df in again for f in df.inputFiles()]
    release(spark)
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
