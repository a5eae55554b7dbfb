import pytest

from lexloom.llm.canonical import edit_cost, map_values, neighbourhood, readings

ENTRIES = [(1, "مَقْوَلَة"), (2, "اِسْتِكْتَاب"), (3, "خَمَّاط"), (4, "مُدَاقَيَة"), (5, "بَيْت كَبِير")]


def mapped(spark, values):
    entries = spark.createDataFrame([(k, t, 0.0) for k, t in ENTRIES], "entry_id long, arabic string, score double")
    df = spark.createDataFrame([(v, 1) for v in values], "value string, entry_id int")
    return {r["value"]: r["entry_id"] for r in map_values(df, "value", entries, "entry_id", "arabic").collect()}


def test_ways_of_typing(spark):
    want = {
        "مقولة": 1, " مقوله ": 1, "المقولة": 1, "والمقولة": 1, "مقـــولة": 1, "مق‌ولة": 1, "مققولة": 1, "مقلوة": 1, "مقول": 1,
        "mqwlp": 1, "AstktAb": 2, "istiktāb": 2, "xamaAT": 3, "ḫammāṭ": 3, "مداقية": 4, "بيت كبير": 5, "بيت  كببر": 5,
        "زززززز": None, "see marrow": None, "TODO 33": None, "--": None, "": None, "بيت": None, "كتاب قديم جدا مقولة": None, "ق" * 50_000: None,
    }
    got = mapped(spark, [*want, *want, None])
    assert got == want
    assert mapped(spark, []) == {}


@pytest.mark.parametrize("a, b, ok", [("abcd", "abcd", True), ("abdc", "abcd", True), ("abc", "abcd", True), ("abxd", "abcd", True), ("abxcd", "abcd", True), ("axxd", "abcd", False), ("badc", "abcd", False)])
def test_edits(a, b, ok):
    assert (edit_cost(a, b) is not None) == ok
    if ok:
        assert neighbourhood(a) & neighbourhood(b)


def test_readings_of_capitals():
    assert ("اننكال", 0.03, True) in readings("AnnkAl")
    assert all(r != "انكال" for r, _, _ in readings("AnnkAl"))
