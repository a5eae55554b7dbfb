import datetime as dt

from pyspark.sql import functions as F

from lexloom.operators.bloom import Bloom, bits_for
from lexloom.operators.references import find_orphans, parents

T = [dt.datetime(2023, m, 1) for m in range(1, 10)]


def test_kinds_ties_and_nulls(spark):
    par = spark.createDataFrame([("a", T[0], None), ("a", T[5], T[6]), ("late", T[4], None), ("gone", T[0], T[2]), (None, T[0], None)], "k string, l timestamp_ntz, d timestamp_ntz")
    refs = spark.createDataFrame(
        [(1, "a", T[1]), (2, "zz", T[1]), (3, "late", T[1]), (4, "late", T[4]), (5, "gone", T[1]), (6, "gone", T[2]), (7, None, T[2]), (8, "gone", None), (2, "zz", T[1])],
        "i int, ref string, at timestamp_ntz",
    )
    known = parents(par, F.col("k"), F.col("l"), F.col("d"))
    got = sorted((r.i, r.orphan_kind) for r in find_orphans(refs, known, "ref", "at").collect())
    assert got == [(2, "missing"), (2, "missing"), (3, "late"), (6, "deleted")]
    assert find_orphans(refs, known.limit(0), "ref", "at").count() == 8
    assert find_orphans(refs.limit(0), known, "ref", "at").count() == 0


def test_bloom_has_no_false_negatives_and_few_positives(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    bloom = Bloom(keys, "k")
    assert keys.filter(bloom.might_contain("k")).count() == 5000
    others = spark.range(5000).select(F.concat(F.lit("x"), F.col("id")).alias("k"))
    assert others.filter(bloom.might_contain("k")).count() < 150
    assert bits_for(10**12) * 1 == 1 << 29
