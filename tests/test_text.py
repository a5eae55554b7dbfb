import unicodedata

import pytest
from pyspark.sql import functions as F

from lexloom.functions import tables as V
from lexloom.functions import text as X
from lexloom.operators import documents as D


def one(spark, value, *columns, kind="string"):
    return tuple(spark.createDataFrame([(value,)], f"x {kind}").select(*columns).first())


@pytest.mark.parametrize("radicals, root", [((11, 22, 23), "س-ل-م"), ((21, 2, 1), "ك-ت-ب"), ((19, 17, 22), "ف-ع-ل"), ((99, 1, 2), "?99-ب-ت")])
def test_roots_from_radicals(spark, radicals, root):
    df = spark.createDataFrame([(*radicals, None)], "a int, b int, c int, d int")
    assert df.select(X.reconstruct_root(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()[0] == root


@pytest.mark.parametrize("word", ["مَسْؤُول", "أَسْدَخ", "آن", "", "abc é", None])
def test_marks_and_letters(spark, word):
    plain, narrow, normal = one(spark, word, X.strip_marks(F.col("x")), X.strip_marks(F.col("x"), wide=False), X.normalize_arabic(F.col("x")))
    if word is None:
        assert plain is None and normal is None
        return
    full = unicodedata.normalize("NFKD", word)
    assert plain == "".join(c for c in full if not 0x64B <= ord(c) <= 0x655)
    assert narrow == "".join(c for c in full if not 0x64B <= ord(c) <= 0x652)
    again = one(spark, normal, X.normalize_arabic(F.col("x")))[0]
    assert again == normal


def test_classes_types_and_parts(spark):
    assert one(spark, "ق-و-ل", X.root_class(F.col("x"))) == ("Triliteral",)
    assert one(spark, "ق-ق-ق", X.root_class(F.col("x"))) == ("BeyondSeptiliteral",)
    assert one(spark, "ق-ق-ل", X.root_class(F.col("x"))) == ("Geminate",)
    assert one(spark, "a b c", X.word_type(F.col("x"))) == ("Phrase",)
    assert one(spark, "كَتَبَ", X.word_type(F.col("x"))) == ("Verb",)
    assert one(spark, "", X.word_type(F.col("x"))) == (None,)
    assert one(spark, "a: b, c: dé, e: 12", X.classification_part(F.col("x"), 1), X.classification_part(F.col("x"), 2), X.classification_part(F.col("x"), 9)) == ("dé", "", "")
    assert one(spark, "Abstract; NA", X.split_class(F.col("x")))[0].asDict() == {"cls": "Abstract", "sub": None}
    assert one(spark, "(1:2:3:x)", X.parse_location(F.col("x"))) == ([1, 2, 3, None],)
    assert one(spark, "LEM:kitAb|M|GEN", X.feature_value(F.col("x"), "LEM"), X.feature_flag(F.col("x"), {"M": "m", "F": "f"})) == ("kitAb", "m")
    assert one(spark, "LEM:x", X.feature_flag(F.col("x"), {"M": "m"})) == (None,)
    assert one(spark, "abcdef", X.ellipsis(F.col("x"), 3), X.hyphenate(F.col("x"))) == ("abc...", "a-b-c-d-e-f")
    assert one(spark, "ktb", X.to_arabic(F.col("x"))) == ("كتب",)


def test_tables_and_providers(spark):
    for code, want in (("4", "أَفْعَلَ"), ("Q. Q. 2", "تَفَعْلَلَ"), ("R.Q.1", "فَعْلَلَ"), ("Q.3", None), ("1 3", None), ("99", None), (None, None)):
        assert one(spark, code, V.weight_of(F.col("x"))) == (want,)
    assert one(spark, "Q.3", V.weight_of(F.col("x"), any_spelling=True), V.weight_of(F.col("x"), {"Q.3": "x"})) == ("افْعَنْلَلَ", "x")
    assert one(spark, "1 3", V.weight_of(F.col("x"), any_spelling=True)) == (None,)
    assert one(spark, "اسم العلة", V.form_number(F.col("x")), V.pattern_name(F.col("x"))) == (9, "UNKNOWN")
    assert one(spark, "a b, c", V.token_count(F.col("x")), V.token_count(F.col("x"), len), V.analyses(F.col("x"), lambda w: [])) == (4, 6, ["NA"])
    assert one(spark, " ab\r\n", V.clean_filename(F.col("x")), V.code_points(F.lit("ab"))) == ("AB", "61 62")


def test_contents_and_nesting(spark):
    lines = [(1, "-lost"), (2, "One, a/b"), (3, ""), (4, "- x"), (5, "Two"), (6, "-y")]
    got = [tuple(r)[1:] for r in D.contents_rows(spark.createDataFrame(lines, "n int, l string"), "n", "l").collect()]
    assert got == [(None, "lost", "lost"), ("One a or b", None, "One a or b"), ("One a or b", "x", "One a or b/x"), ("Two", None, "Two"), ("Two", "y", "Two/y")]
    nested = spark.createDataFrame([("p", [("d", [("r1",), ("r2",)])])], "name string, dbs array<struct<name:string,rows:array<struct<title:string>>>>")
    assert [tuple(r) for r in D.nested_rows(nested, "dbs", "rows").collect()] == [("p", "d", "r1"), ("p", "d", "r2")]
