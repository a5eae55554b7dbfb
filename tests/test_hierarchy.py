import random

import pytest

from pyspark.sql import functions as F

from lexloom.operators import hierarchy
from lexloom.operators.hierarchy import descendants, resolve_hierarchy


def brute(links):
    up = dict(links)
    out = {}
    for x in up:
        way, y = [x], x
        while True:
            p = up[y]
            if p is None or p not in up:
                way.reverse()
                out[x] = (way[0], len(way) - 1, "/".join(map(str, way)))
                break
            if p in way:
                loop = way[way.index(p) :]
                out[x] = (min(loop), -1 if x in loop else -2, "")
                break
            way.append(p)
            y = p
    return out


def solve(spark, links, fragment):
    df = spark.createDataFrame(links, "id long, parent long")
    return {r.id: (r.top_id, r.tree_depth, r.id_path) for r in resolve_hierarchy(df, "id", "parent", fragment).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_forests_with_loops_and_gaps(spark, seed):
    rng = random.Random(seed)
    n = 60
    links = [(i, rng.choice([None, rng.randrange(n + 5), rng.randrange(max(1, i)), i - 1 if i else None])) for i in range(n)]
    assert solve(spark, links, 8) == brute(links)


def test_one_chain_over_many_fragments(spark):
    order = list(range(80))
    random.Random(0).shuffle(order)
    links = [(a, b) for a, b in zip(order[1:], order)] + [(order[0], None)]
    assert solve(spark, links, 10) == brute(links)


def test_loop_over_many_fragments(spark):
    order = list(range(40))
    random.Random(5).shuffle(order)
    links = [(a, b) for a, b in zip(order, order[1:] + order[:1])] + [(100, 3), (101, 100), (102, 102), (103, 102)]
    assert solve(spark, links, 6) == brute(links)


def test_hot_parent_nulls_and_repeats(spark):
    links = [(1, None)] + [(i, 1) for i in range(2, 60)] + [(None, 1), (None, None), (7, 1)]
    got = solve(spark, links, 10)
    assert got[7] == (1, 1, "1/7") and got[1] == (1, 0, "1") and len(got) == 59


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([], "id long, parent long, seg string, state int")
    assert resolve_hierarchy(df, "id", "parent").count() == 0
    df = spark.createDataFrame([(1, None, "x", 1), (2, 1, "y", 3)], "id long, parent long, seg string, state int")
    solved = resolve_hierarchy(df, "id", "parent")
    assert [tuple(r) for r in descendants(solved).collect()] == [(1, 2, 1)]


def test_jumping_gives_the_same_as_levels(spark):
    rng = random.Random(11)
    n = 300
    order = list(range(n))
    rng.shuffle(order)
    up = {x: (order[i - 1] if i % 37 else rng.choice([None, 10_000 + i])) for i, x in enumerate(order)}
    for a, b in ((3, 9), (50, 60), (200, 240)):  # loops in the shuffled chains, with what hangs below
        up[order[a]] = order[b]
    up[order[100]] = order[100]
    links = list(up.items()) + [(n + i, rng.choice(order)) for i in range(40)]
    assert solve(spark, links, 5) == brute(links)


def test_shuffled_chains_stay_within_fragments(spark, monkeypatch):
    """The chains that hardly contract: no task holds more than a few fragments."""
    n, fragment, sizes = 200_000, 1_000, []
    counted = hierarchy._fragments

    def watched(nodes, parts):
        placed = nodes.repartitionByRange(parts, "id") if parts > 1 else nodes.coalesce(1)
        sizes.append(placed.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0])
        return counted(nodes, parts)

    monkeypatch.setattr(hierarchy, "_fragments", watched)
    place = (F.col("id") * 100_003) % n  # a permutation, as 100003 is a prime that does not divide n
    links = spark.range(n).select(place.alias("id"), F.when(F.col("id") % 50 != 0, (F.col("id") - 1) * 100_003 % n).alias("parent"))
    out = resolve_hierarchy(links, "id", "parent", fragment)
    depth = out.agg(F.count("*"), F.sum("tree_depth"), F.max("tree_depth"), F.countDistinct("top_id")).first()
    assert tuple(depth) == (n, n // 50 * sum(range(50)), 49, n // 50)
    assert sizes and max(sizes) <= 3 * fragment
    wrong = out.filter((F.size(F.split("id_path", "/")) != F.col("tree_depth") + 1) | (F.substring_index("id_path", "/", -1) != F.col("id").cast("string")) | (F.substring_index("id_path", "/", 1) != F.col("top_id").cast("string")))
    assert wrong.count() == 0
