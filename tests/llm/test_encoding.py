import pytest

from lexloom.llm.encoding import chains, garble, hypotheses, restore

CLEAN = ["déjà vu à la fenêtre", "القصر القديم في كتاب", "SÃO and ÂME stay", "Form 1 again???", "mañana ¿Y la glosa entera? — “si”", "ṯākiḍ and wāṯil", "Où est la porte ? oui", "قصر جميل", "Mark Ø means £"]


def run(spark, rows):
    df = spark.createDataFrame([(i, "content", t, "x") for i, t in enumerate(rows)], "msg_id long, field_name string, text string, token string")
    return {r.msg_id: r.restored for r in restore(df, ["msg_id", "field_name"], "text").collect()}


def test_every_chain_round_trips(spark):
    garbled = [(t, garble(t, c)) for t in CLEAN[:2] + CLEAN[5:6] for c in chains()]
    got = run(spark, CLEAN + [g for _, g in garbled])
    assert not set(got) & set(range(len(CLEAN)))
    right = sum(got.get(len(CLEAN) + i) == t for i, (t, _) in enumerate(garbled))
    assert right >= 0.9 * len(garbled)
    for depth_one in [i for i, c in enumerate(chains() * 3) if len(c) == 1]:
        assert got[len(CLEAN) + depth_one] == garbled[depth_one][0]


def test_parts_lost_letters_and_one_byte_chains(spark):
    rows = CLEAN + ["see " + garble("كتاب", ("cp1256",)) + " here", "شكر� جميل", "see ???? here", "ma??n and", "القصر القديم".encode("cp1256").decode("latin-1"), "means folding \x97 or", None, "", "x" * 200_000 + " " + garble("déjà", ("latin-1",))]
    got = run(spark, rows)
    n = len(CLEAN)
    assert got[n] == "see كتاب here"
    assert [got[n + i] for i in (1, 2, 3)] == ["", "", ""]
    assert got[n + 4] == "القصر القديم" and got[n + 5] == "means folding — or"
    assert n + 6 not in got and n + 7 not in got
    assert got[n + 8].endswith(" déjà") and len(got[n + 8]) == 200_005


def test_empty(spark):
    assert run(spark, []) == {}


@pytest.mark.parametrize("word", ["déjà", "كتاب"])
def test_hypotheses(word):
    known = set(word) | set("abcdefghijklmnopqrstuvwxyz")
    for c in chains():
        assert word in hypotheses(garble(word, c), known)
    assert hypotheses(word, known) == []
