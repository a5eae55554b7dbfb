from lexloom.operators.packed_values import parse, split_packed


def rows(spark, fields):
    df = spark.createDataFrame(list(enumerate(fields)), "row_id long, classification string")
    out = {}
    for r in sorted(split_packed(df, "row_id", "classification").collect(), key=lambda r: (r.row_id, r.item_pos)):
        out.setdefault(r.row_id, []).append((r.attr, r.val))
    return out


def test_quotes_protect_and_double():
    assert parse('a: "x, y", b: \'p; q\', c', ",", True) == [("a", "x, y"), ("b", "p; q"), ("", "c")]
    assert parse('g: "so-called ""weak"" verb", “n: 1, 2”', ",", True) == [("g", 'so-called "weak" verb'), ("n", "1, 2")]
    assert parse("w: Fa'ala, g: the copyist's garden", ",", True) == [("w", "Fa'ala"), ("g", "the copyist's garden")]


def test_dialect_is_chosen_by_description_length(spark):
    base = ["word: a, number: dual, prefix: \"w, al\"", "word: b, number: plural, prefix: \"w, al\"", "word: c; number: dual; prefix: «w, al»"] * 3
    got = rows(spark, base + ["word: d; number: dual; prefix: w, al"])
    assert got[9] == [("word", "d"), ("number", "dual"), ("prefix", "w, al")]
    assert got[2] == [("word", "c"), ("number", "dual"), ("prefix", "w, al")]


def test_nulls_blanks_long_and_repeats(spark):
    long = ", ".join(f"k{i}: v{i}" for i in range(5000))
    df = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (3, " NA ", 0), (4, "a: 1,, ,b=2,", 0), (4, "a: 1,, ,b=2,", 0), (5, long, 0)],
        "row_id long, classification string, item_pos int",
    )
    got = split_packed(df, "row_id", "classification")
    assert got.filter("row_id = 4").count() == 2
    assert got.filter("row_id = 5").count() == 5000
    assert got.filter("row_id < 4").count() == 0
    assert split_packed(df.limit(0), "row_id", "classification").count() == 0
