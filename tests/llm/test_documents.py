import math
import random
import re

from pyspark.sql import functions as F

from lexloom.llm.leakage import find_leaks
from lexloom.llm.mixing import TOKENIZER, _encoding, choose, count_tokens, entropy, mix, most_tokens, powered, target_weights, temperature
from lexloom.llm.truncation import at_limit, candidates, find_truncated


def brute_leaks(docs, items, run=10):
    def words(t):
        return [w for w in re.sub(r"[^\w\sʿʾ]|_|[ً-ٰٟ]", "", (t or "").lower()).split() if w]

    def grams(t):
        w = words(t)
        return {tuple(w[i : i + run]) for i in range(len(w) - run + 1)}

    return {(d, i) for d, t in docs for i, u in items if grams(t) & grams(u)}


def test_leaks_against_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([8, 10, 25])))) for i in range(12)]
    docs = []
    for d in range(120):
        w = [rng.choice(vocab) for _ in range(40)]
        src = items[rng.randrange(12)][1].split()
        n = rng.choice([6, 9, 10, 11, 25])
        at = rng.randrange(max(1, len(src) - n + 1))
        part = [x.upper() + rng.choice(["", ",", "."]) for x in src[at : at + n]]
        p = rng.randrange(40)
        docs.append((d, "  ".join(w[:p] + part + w[p:])))
    docs += [(500, None), (501, ""), (0, docs[0][1]), (502, items[3][1] * 1)]
    df = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item_id int")
    it = spark.createDataFrame(items + [(90, None), (91, "short one")], "item_id long, text string")
    got = {tuple(r) for r in find_leaks(df, it, "doc_id", "text", "item_id", "text").collect()}
    assert got == brute_leaks(docs, items)
    assert find_leaks(df.limit(0), it, "doc_id", "text", "item_id", "text").count() == 0
    assert find_leaks(df, it.limit(0), "doc_id", "text", "item_id", "text").count() == 0


def test_vowel_marks_and_signs_do_not_count(spark):
    text = "كَتَبَ الوَلَدُ رسالة الى صديقه في المدينة قبل يوم العيد"
    bare = "«كتب» الولد - رسالة، الى صديقه في المدينة قبل يوم العيد"
    df = spark.createDataFrame([(1, bare)], "doc_id long, text string")
    it = spark.createDataFrame([(2, text)], "item_id long, text string")
    assert find_leaks(df, it, "doc_id", "text", "item_id", "text").count() == 1


def test_truncation(spark):
    end = ["The bowl stands next to the kiln.", "Travellers brought a vessel along.", "Hardly a bridge is named before."]
    verse = "over the yoke\nunder the drum we stand\na bowl over the bridge\nthe kiln is gone"
    docs = [(i, f"{end[i % 3]} {end[(i + 1) % 3]}", "a") for i in range(60)]
    docs += [(100 + i, f"{end[i % 3]}\nThanks all", "a") for i in range(6)]
    docs += [(200 + i, verse, "v") for i in range(30)] + [(310 + i, "- see: vessel\n- root: bridge", "a") for i in range(3)] + [(300, "- root: bridge\n- see: vessel", "a"), (301, f"{end[0]} (bowl)", "a"), (302, f"{end[0]} …", "a")]
    cut = [(400, "The bowl stands next to the ki", "a"), (401, "The bowl stands next to", "a"), (402, "over the yoke\nunder the drum we stand\na bowl over the brid", "v"), (403, f"{end[1]}\nTravellers brought a", None), (404, "Hardly a bridge: ", "a")]
    other = [(500, None, "a"), (501, "", "a"), (502, " \n ", None), (400, "The bowl stands next to the ki", "a")]
    df = spark.createDataFrame([(*x, 0) for x in docs + cut + other], "doc_id long, text string, source string, n int")
    got = {r.doc_id for r in find_truncated(df, "doc_id", "text", "source").collect()}
    assert got == {400, 401, 402, 403, 404}
    assert find_truncated(df.limit(0), "doc_id", "text", "source").count() == 0


def test_trie_judges_prose_too(spark):
    docs = [(i, "The bowl stands next to the kiln.", "a") for i in range(20)] + [(30, "The bowl stands next to the ki", "a"), (31, "The bowl stands next to the", "a")]
    df = spark.createDataFrame(docs, "doc_id int, text string, source string")
    assert {r.doc_id: r.reason for r in find_truncated(df, "doc_id", "text", "source").collect()} == {30: "prefix", 31: "line"}


def test_lines_that_end_open_by_design_are_learned(spark):
    rng = random.Random(8)
    nouns = [f"{a}{b}{c}" for a in "bdgkl" for b in ("ara", "olo", "umi", "ete") for c in ("n", "m", "sh", "")]

    def prose():
        return f"Pupils read the {rng.choice(nouns)} and the {rng.choice(nouns)} of the school."

    def entry():
        return f"~ {rng.choice(nouns)} >> {rng.choice(nouns)}"  # a list form that no pattern names

    docs = [(i, "\n".join([prose() for _ in range(3)] + [entry() for _ in range(4)]), "a") for i in range(60)]
    docs += [(100 + i, "\n".join([prose(), entry(), prose()]), "a") for i in range(20)]
    cut = [(200, f"{prose()}\n{prose()}\nPupils read the {nouns[0]} and the {nouns[1]}", "a"), (201, f"Pupils read the {nouns[3]}", "a")]
    df = spark.createDataFrame(docs + cut, "doc_id int, text string, source string")
    assert {r.doc_id: r.reason for r in find_truncated(df, "doc_id", "text", "source").collect()} == {200: "line", 201: "line"}


def test_limits_pile_up_in_characters_and_bytes(spark):
    rng = random.Random(9)

    def words(n):
        return " ".join(rng.choice(["kalb", "bēt", "nūr", "dār", "šams"]) for _ in range(n))

    rows = [(i, words(80).encode()[:300].decode("utf-8", "ignore"), "bytes") for i in range(60)] + [(100 + i, words(80)[:200], "chars") for i in range(60)]
    rows += [(200 + i, words(rng.randrange(20, 60)), "free") for i in range(60)]
    ends = candidates(spark.createDataFrame(rows, "doc_id int, text string, source string"), "doc_id", "text", "source").withColumn("source", F.col("_source"))
    full = {r.doc_id: r._full for r in at_limit(ends, ends, "doc_id").collect()}
    whole = {i for i, t, s in rows if s != "free"}
    assert set(full) == whole and {full[i] for i in range(100, 160)} == {2} and {full[i] for i in range(60)} == {1, 2}


def test_quotes_close_only_with_their_partner(spark):
    whole = ["He read 'the jar'", 'She said "the bowl"', "Il lit «la cruche»", "He read “the jar”", "She said ‘don’t go’", "It is said (of jars)", "They asked 'is it l'eau'", 'It was "done."', "La fin.'"]
    cut = ["Une racine parmi d'", "Le sens de l'", "Il faut qu’", "Il dit 'oui' et puis d'", 'Then it said jars"', "On lit la cruche»", "the learners'", 'He "read" the jar"']
    df = spark.createDataFrame(list(enumerate(whole + cut)), "doc_id int, text string").withColumn("source", F.lit("a"))
    got = {r.doc_id for r in find_truncated(df, "doc_id", "text", "source").collect()}
    assert got == set(range(len(whole), len(whole) + len(cut)))


def test_mid_line_evidence_does_not_depend_on_size(spark):
    rng = random.Random(5)

    def word():
        return "".join(rng.choice("bdfgklmprstvz") + rng.choice("aeiou") for _ in range(3))

    def line():
        return f"{word()} for the {word()} and {word()} for the {word()}"

    docs = [(i, "\n".join(line() for _ in range(8)), "v") for i in range(12)] + [(100 + i, f"The kiln is an old one, {word()}.", "a") for i in range(20)]
    cut = [(200, f"{line()}\n{line()}\n{word()} for the {word()} an", "v"), (201, f"{line()}\n{line()}\n{word()} for the", "v")]
    once = spark.createDataFrame(docs + cut, "doc_id long, text string, source string")
    assert {r.doc_id for r in find_truncated(once, "doc_id", "text", "source").collect()} == {200, 201}
    ten = once.withColumn("doc_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.col("doc_id") * 10 + i)))
    assert {r.doc_id for r in find_truncated(ten, "doc_id", "text", "source").collect()} == {i * 10 + k for i in (200, 201) for k in range(10)}
    stray = once.unionByName(spark.createDataFrame([(300, "an old kiln for an\nand then it ended.", "a")], once.schema))
    assert {r.doc_id for r in find_truncated(stray, "doc_id", "text", "source").collect()} == {200, 201}


def test_tokens_are_those_of_the_tokenizer():
    for t in ["Hello  world's\n\n end", "كَتَبَ الولد", "a" * 500, "", "  x\t\ty ", "don't 123,456 — ok"]:
        assert count_tokens(t) == len(_encoding(TOKENIZER).encode_ordinary(t))


def test_mix_meets_shares_and_limits(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(["word"] * rng.randrange(5, 60)), rng.choice(["big"] * 8 + ["mid", "tiny"] + [None])) for i in range(3000)]
    df = spark.createDataFrame([(*d, 5) for d in docs] + [(0, None, "big", 5)], "doc_id long, text string, source string, repeats int")
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("tiny", 0.1, 3), ("none", 0.1, 9), (None, 0.0, 1)], "source string, target_share double, max_repeats int")
    chosen, shares = mix(df, targets, "doc_id", "text", "source", exact=True)
    got = {r.source: r for r in shares.collect()}
    for s, w, most in (("big", 0.5, 1), ("mid", 0.3, 2), ("tiny", 0.1, 3)):
        assert abs(got[s].actual_share - w / 0.9) < 0.005 and got[s].most_repeats <= most
    assert got["none"].tokens == 0
    assert chosen.count() == chosen.select("doc_id", "pass").distinct().count()
    assert mix(df.limit(0), targets, "doc_id", "text", "source")[0].count() == 0
    assert mix(df, targets.limit(0), "doc_id", "text", "source")[0].count() == 0
    sized = df.groupBy("doc_id").agg(F.max("source").alias("source")).filter("source = 'mid'").withColumn("n_tokens", F.lit(10).cast("long"))
    n = sized.count()
    part = choose(sized, "doc_id", "source", {"mid": 10.0 * n * 1.5}, {"mid": 10 * n}, {"mid": 2}, n)
    assert abs(part.count() - 1.5 * n) <= 1
    again = {r.doc_id: r.repeats for r in part.collect()}
    assert set(again.values()) == {1, 2} and sum(again.values()) == part.filter("pass = 1").count() + part.filter("pass = 2").count()


def test_temperature_against_a_grid():
    totals, repeats, targets = {"a": 5200, "b": 2600, "c": 900, "d": 130}, {"a": 1, "b": 1, "c": 2, "d": 4}, {"a": 0.4, "b": 0.25, "c": 0.2, "d": 0.15}
    aim = -sum(w * math.log(w) for w in targets.values())
    n = sum(totals.values())

    def weights(e):
        raw = {s: (t / n) ** e for s, t in totals.items()}
        return {s: r / sum(raw.values()) for s, r in raw.items()}

    def off(e):
        return abs(-sum(w * math.log(w) for w in weights(e).values()) - aim)

    grid = min((i / 10_000 for i in range(30_001)), key=off)
    a, w, size = temperature(totals, repeats, aim)
    assert 0.05 < a < 0.95 and abs(a - grid) < 1e-4 and abs(entropy(w) - aim) < 1e-9
    assert abs(size - min(repeats[s] * totals[s] / weights(grid)[s] for s in totals)) < 2
    # A total that the limits do not allow at this exponent moves it on, just as far as it must.
    larger = (size + n) / 2
    b, u, got = temperature(totals, repeats, aim, larger)
    assert a < b < 1 and got == larger and all(u[s] * larger <= repeats[s] * totals[s] + 1e-6 for s in totals)
    assert most_tokens(totals, weights(b - 1e-3), repeats) < larger
    c, v, most = temperature(totals, repeats, aim, 10.0 * n)
    assert c == 1 and abs(most - n) < 1e-6 and abs(v["a"] - 5200 / n) < 1e-9


def test_mix_by_one_exponent_is_realised_in_blocks(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(["word"] * rng.randrange(3, 40)), s) for i, s in enumerate(["a"] * 2600 + ["b"] * 1300 + ["c"] * 450 + ["d"] * 70)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.25, 1), ("c", 0.2, 2), ("d", 0.15, 4)], "source string, target_share double, max_repeats int")
    chosen, shares = mix(df, targets, "doc_id", "text", "source")
    got = {r.source: r for r in shares.collect()}
    tokens = {i: (s, count_tokens(t)) for i, t, s in docs}
    natural = {s: sum(n for z, n in tokens.values() if z == s) for s in "abcd"}
    exponent = got["a"].exponent
    assert 0.05 < exponent < 0.95 and {r.exponent for r in got.values()} == {exponent}
    raw = {s: n**exponent for s, n in natural.items()}
    rows = chosen.collect()
    size = sum(r.n_tokens for r in rows)
    taken = {s: sum(r.n_tokens for r in rows if r.source == s) for s in "abcd"}
    for s in "abcd":
        assert abs(taken[s] / size - raw[s] / sum(raw.values())) < 0.01 and got[s].tokens == taken[s]
        assert abs(got[s].off_target - (taken[s] / size - {"a": 0.4, "b": 0.25, "c": 0.2, "d": 0.15}[s])) < 1e-5
    times = {}
    for r in rows:
        assert tokens[r.doc_id] == (r.source, r.n_tokens)
        times.setdefault(r.doc_id, []).append(r)
    assert all(len(x) == x[0].repeats == len({r["pass"] for r in x}) <= {"a": 1, "b": 1, "c": 2, "d": 4}[x[0].source] for x in times.values())
    # A whole pass holds every document before the next begins, and halves of the blocks have the weights of the mix.
    assert len({r.doc_id for r in rows if r.source == "d" and r["pass"] == 1}) == 70
    for half in (range(32), range(32, 64)):
        part = [r for r in rows if r.block in half]
        n = sum(r.n_tokens for r in part)
        assert all(abs(sum(r.n_tokens for r in part if r.source == s) / n - taken[s] / size) < 0.03 for s in "abcd")


def test_plans():
    assert target_weights({"a": 100}, {"a": 1.0}, {"a": 2}) == ({"a": 1.0}, 200.0)
    w, n = target_weights({"a": 900, "b": 100}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 4})
    assert w == {"a": 0.5, "b": 0.5} and abs(n - 800) < 1e-6 and target_weights({"a": 900, "b": 100}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 4}, 10.0)[1] == 10
    assert abs(sum(powered({"a": 0.9, "b": 0.1}, 0.3).values()) - 1) < 1e-9
