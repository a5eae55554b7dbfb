import random

from pyspark.sql import functions as F

from lexloom.llm.conversations import message_parents, rebuild, thread


def test_thread_finds_paths_orphans_and_cycles(spark):
    order = list(range(1, 60))
    random.Random(3).shuffle(order)
    rows = [(order[0], None, "r")] + [(b, a, "s") for a, b in zip(order, order[1:])]
    rows += [(100, 999, "o"), (101, 100, "o"), (200, 201, "c"), (201, 200, "c"), (202, 200, "c"), (300, 300, "c"), (None, 1, "n")]
    got = {r.n: (r.root, r.depth, r.root_speaker, r.broken) for r in thread(spark.createDataFrame(rows, "n long, p long, s string"), "n", "p", "s").collect()}
    assert all(got[x] == (order[0], i, "r", False) for i, x in enumerate(order))
    assert all(got[x][3] and got[x][0] is None for x in (100, 101, 200, 201, 202, 300))
    assert thread(spark.createDataFrame([], "n long, p long, s string"), "n", "p", "s").count() == 0


def test_parents_over_many_partitions(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") * 37 % 500).alias("t"), F.col("id").alias("m"))
    got = {r.m: r.parent for r in message_parents(df, "g", ["t", "m"], "m", 13).collect()}
    for g in range(3):
        rows = sorted((m * 37 % 500, m) for m in range(500) if m % 3 == g)
        assert got[rows[0][1]] is None
        assert all(got[b[1]] == a[1] for a, b in zip(rows, rows[1:]))


def test_rules(spark):
    names = spark.createDataFrame([("p", ["a", "b"]), ("q", ["a", "b"]), ("z", ["a", "c"]), ("w", ["d", "e"])], "participants string, members array<string>")
    rows = [
        (5, "p", "a", 10, "hi"), (3, "q", "b", 10, "yo"), (9, "p", "a", 12, "  "), (8, "q", "a", 10, "hi"), (7, "p", "b", 20, "hi"),
        (20, "z", "a", 1, "x"), (21, "z", "c", 2, ""), (22, "z", None, 3, "n"),
        (30, "w", "d", 1, "only"), (31, "w", "e", 2, None),
        (40, None, "a", 1, "x"), (41, "unknown", "a", 1, "x"),
    ]
    df = spark.createDataFrame(rows, "msg_id long, participants string, sender string, timestamp_ms long, content string")
    got = sorted(tuple(r) for r in rebuild(df, names).collect())
    assert got == [(3, 1, 3, "asker"), (3, 2, 5, "replier"), (3, 3, 7, "asker")]
    assert rebuild(df.limit(0), names).count() == 0
