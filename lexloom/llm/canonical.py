"""Free-entered words mapped to the entries of a reference list.

Values are repaired word by word. Each distinct word gets its readings (folded
script, article taken off, two transliterations undone); readings meet the
reference vocabulary in an equi-join on deletion neighbourhoods, which holds every
pair within the allowed edits, and are verified. The repaired words are then
weighted by soft TF-IDF to rank whole entries; values whose best entry scores too
low, or that share no word with any, map to none.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

# Letters that count as one, articles with what may precede them, the Buckwalter and the scholarly transliteration.
FOLD = str.maketrans("أإآٱىةیکھؤئ", "اااايهيكهوي")
ARTICLES = ("وال", "بال", "فال", "كال", "ولل", "ال", "لل")
BUCKWALTER = str.maketrans("'|>&<}AbptvjHxd*rzs$SDTZEgfqklmnhwYy{", "ءآأؤإئابةتثجحخدذرزسشصضطظعغفقكلمنهوىيٱ", "aiuoFNK~`_")
SCHOLARLY = str.maketrans("ʾbtṯǧḥḫdḏrzsšṣḍṭẓʿġfqklmnhwyāīū", "ابتثجحخدذرزسشصضطظعغفقكلمنهويايو", "aiu")

MAX_EDITS = 1
EDIT_COST, LESS_LIKELY, READ_COST = 0.12, 0.02, 0.03
ACCEPT = 0.8
#: Shorter readings of transliterated words must match without an edit.
SHORTEST_EDITED = 5

_MARKS = re.compile("[ً-ٰٟـ]")
_ARABIC = re.compile("[؀-ۿ]")
_BUCKWALTER = re.compile(r"['|>&<}AbptvjHxd*rzs$SDTZEgfqklmnhwYy{aiuoFNK~`_]+")
_SCHOLARLY = re.compile("[ʾbtṯǧḥḫdḏrzsšṣḍṭẓʿġfqklmnhwyāīūaiu]+")
_DOUBLED = re.compile(r"([^aiuāīū])\1")


def fold(word: str) -> str:
    """Letters alone: compatibility forms composed, invisible signs, vowel marks and stretching gone, variants as one."""
    word = "".join(c for c in unicodedata.normalize("NFKC", word) if unicodedata.category(c) != "Cf")
    return _MARKS.sub("", word).translate(FOLD)


def readings(word: str) -> list[tuple[str, float, bool]]:
    """(letters, cost, whether an edit may be allowed) for each way to read a typed word."""
    out: dict[str, tuple[float, bool]] = {}

    def add(letters: str, cost: float, edits: bool) -> None:
        if letters and (letters not in out or out[letters][0] > cost):
            out[letters] = (cost, edits)

    plain = fold(word)
    if _ARABIC.search(plain):
        add(plain, 0.0, True)
        for a in ARTICLES:
            if plain.startswith(a) and len(plain) - len(a) >= 3:
                add(plain[len(a) :], READ_COST, True)
                break
        return [(r, c, e) for r, (c, e) in out.items()]
    if _BUCKWALTER.fullmatch(plain):
        r = fold(plain.translate(BUCKWALTER))
        add(r, READ_COST, len(r) >= SHORTEST_EDITED)
    latin = unicodedata.normalize("NFC", word.strip())
    # Capitals are letters of their own in the one, and of a sentence in the other.
    latin = latin if latin.isascii() else latin.lower()
    if _SCHOLARLY.fullmatch(latin):
        for w in (_DOUBLED.sub(r"\1", latin), latin):
            r = ("ا" if w[0] in "aiu" else "") + w.translate(SCHOLARLY)
            add(r, READ_COST, len(r) >= SHORTEST_EDITED)
    return [(r, c, e) for r, (c, e) in out.items()]


def neighbourhood(word: str, edits: int = MAX_EDITS) -> set[str]:
    """The word and what is left after up to ``edits`` deletions; two words within as many edits share one."""
    out = {word}
    for k in range(1, min(edits, len(word) - 1) + 1):
        out |= {"".join(c for i, c in enumerate(word) if i not in gone) for gone in map(set, combinations(range(len(word)), k))}
    return out


def edit_cost(typed: str, meant: str, most: int = MAX_EDITS) -> float | None:
    """Cost of the cheapest edits from ``meant`` to ``typed``, swaps of neighbours being one; None beyond ``most``.

    Slips that lose or swap letters cost a little less than those that add or
    replace one: there are fewer of the former that a writer can make.
    """
    if typed == meant:
        return 0.0
    if abs(len(typed) - len(meant)) > most:
        return None
    rare = EDIT_COST + LESS_LIKELY
    rows = [[j * rare for j in range(len(typed) + 1)]]
    for i, m in enumerate(meant, 1):
        row = [i * EDIT_COST]
        for j, t in enumerate(typed, 1):
            best = min(rows[-1][j] + EDIT_COST, row[-1] + rare, rows[-1][j - 1] + (0 if m == t else rare))
            if i > 1 and j > 1 and m == typed[j - 2] and meant[i - 2] == t:
                best = min(best, rows[-2][j - 2] + EDIT_COST)
            row.append(best)
        rows.append(row)
    return rows[-1][-1] if rows[-1][-1] <= most * rare + 1e-9 else None


def _split(values: DataFrame, column: str, *keep: str) -> DataFrame:
    return values.select(*keep, F.posexplode(F.split(F.trim(F.regexp_replace(column, r"(?U)\s+", " ")), " ")).alias("_i", "_word")).filter("_word <> ''")


def map_values(values: DataFrame, column: str, entries: DataFrame, entry_key: str, entry_text: str, max_edits: int = MAX_EDITS, accept: float = ACCEPT) -> DataFrame:
    """(column, entry_key, score) for each distinct value; entry_key and score are null for values that mean none.

    Null values give no row; blank ones map to none. Of entries that score alike,
    the one with the smallest key. Words and values of any length are used whole.
    Either table may be empty; repeated rows count once; other columns are
    ignored. All joins are equi-joins of distinct words, left to the planner.
    """
    distinct = stage(values.select(F.col(column).alias("_value")).filter(F.col("_value").isNotNull()).distinct(), "values")

    def refer(batches):
        for pdf in batches:
            rows = [(k, i, fold(w)) for k, t in zip(pdf["k"], pdf["t"]) for i, w in enumerate(str(t).split())]
            yield pd.DataFrame(rows, columns=["k", "i", "w"]).astype({"k": pdf["k"].dtype})

    kind = entries.schema[entry_key].dataType.simpleString()
    listed = entries.select(F.col(entry_key).alias("k"), F.col(entry_text).alias("t")).dropna().distinct()
    words = stage(listed.mapInPandas(refer, f"k {kind}, i int, w string"), "entry_words")
    total = listed.count()
    idf = words.groupBy("w").agg(F.log1p(F.lit(float(total)) / F.countDistinct("k")).alias("idf"))
    weighted = words.join(idf, "w")
    norms = weighted.groupBy("k").agg(F.sqrt(F.sum(F.col("idf") ** 2)).alias("e_norm"))

    def spread(batches):
        for pdf in batches:
            rows = [(w, n) for w in pdf["w"] for n in neighbourhood(w, max_edits)]
            yield pd.DataFrame(rows, columns=["w", "near"])

    reference = stage(words.select("w").distinct().mapInPandas(spread, "w string, near string"), "reference")

    def read(batches):
        for pdf in batches:
            rows = [
                (t, r, c, e, n)
                for t in pdf["_word"]
                for r, c, e in readings(t)
                for n in (neighbourhood(r, max_edits) if e else (r,))
            ]
            yield pd.DataFrame(rows, columns=["_word", "r", "cost", "edits", "near"])

    tokens = stage(_split(distinct, "_value", "_value"), "value_words")
    read_words = tokens.select("_word").distinct().mapInPandas(read, "_word string, r string, cost double, edits boolean, near string")
    met = read_words.join(reference, "near").select("_word", "r", "cost", "edits", "w").distinct()

    @F.pandas_udf("double")
    def verify(r: pd.Series, w: pd.Series, edits: pd.Series) -> pd.Series:
        return pd.Series([edit_cost(a, b, max_edits) if e or a == b else None for a, b, e in zip(r, w, edits)], dtype="float64")

    similar = (
        met.withColumn("edit", verify("r", "w", "edits"))
        .filter(F.col("edit").isNotNull() & ~F.isnan("edit"))
        .groupBy("_word", "w")
        .agg((1 - F.min(F.col("cost") + F.col("edit"))).alias("sim"))
    )
    best_idf = similar.join(idf, "w")
    # A word that matches nothing weighs as much as the rarest word of the list.
    rarest = F.log1p(F.lit(float(total)))
    own = best_idf.groupBy("_word").agg(F.max_by("idf", "sim").alias("own_idf"))
    v_norms = tokens.join(own, "_word", "left").groupBy("_value").agg(F.sqrt(F.sum(F.coalesce("own_idf", rarest) ** 2)).alias("v_norm"))
    hits = (
        tokens.join(best_idf.join(words.select("k", "w").distinct(), "w"), "_word")
        .groupBy("_value", "k", "_i")
        .agg(F.max(F.col("sim") * F.col("idf") ** 2).alias("part"))
        .groupBy("_value", "k")
        .agg(F.sum("part").alias("dot"))
    )
    scored = hits.join(norms, "k").join(v_norms, "_value").withColumn("score", F.col("dot") / (F.col("e_norm") * F.col("v_norm"))).filter(F.col("score") >= accept)
    top = scored.groupBy("_value").agg(F.min(F.struct((-F.round("score", 9)).alias("s"), F.col("k"))).alias("t"))
    return distinct.join(top, "_value", "left").select(F.col("_value").alias(column), F.col("t.k").alias(entry_key), (-F.col("t.s")).alias("score"))


def typed(value: Column) -> Column:
    """Whether a field holds a value at all."""
    plain = F.regexp_replace(value, r"(?U)^\s+|\s+$", "")
    return value.isNotNull() & ~plain.isin("", "NA", "None")
