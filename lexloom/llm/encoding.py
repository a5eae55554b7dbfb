"""Text that was decoded with the wrong character encoding.

Every distinct clean word of the corpus is garbled under every chain of wrong
decodings, and the garbled forms are hash-joined with the corpus's suspicious
words; a match substitutes the original. Words that no clean text of the corpus
holds are added as hypotheses, decoded from the suspicious word itself; they go
through the same table, so that only what garbles to exactly the written form is
ever substituted, and only if all its letters occur in clean words. A suspicious
word that no form of the table matches stays as it is.

A *word* is a run of letters and of anything beyond ASCII, or several such runs
joined by hyphens: wrong decodings keep ASCII as it is and never make any of it.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

#: UTF-8 read as one of these; bytes that have no character stay control characters.
CODECS = ("latin-1", "cp1252", "cp1256", "mac_roman")
DEPTH = 2
#: Text of the first encoding read as the second, both of one byte a character.
LEGACY = (("cp1256", "latin-1"), ("cp1252", "latin-1"))
_RUN = r"[^\x00-\x40\x5b-\x60\x7b-\x7f]+"
WORD = rf"{_RUN}(?:-{_RUN})*"
SEGMENT = WORD + r"|[\x00-\x40\x5b-\x60\x7b-\x7f]+"
#: A whole word of two characters or more from the upper half of Latin-1.
LEGACY_SHAPE = r"(?<![^\x00-\x40\x5b-\x60\x7b-\x7f])[\u00a1-\u00ff](?:-?[\u00a1-\u00ff])+(?![^\x00-\x40\x5b-\x60\x7b-\x7f])"
LOST = "�"
#: Question marks that stand for letters: inside or before a word, alone as a word of two or more, or joined by hyphens.
LOST_MARKS = r"[\p{L}\p{M}]\?+[\p{L}\p{M}]|(?<![^\s(\[\"'“«])\?{2,}|(?<![^\s(\[\"'“«])\?+[\p{L}\p{M}]|\?-\?|[\p{L}\p{M}]-\?|\?-[\p{L}\p{M}]"


@lru_cache(maxsize=None)
def _chars(codec: str) -> tuple[str, ...]:
    """The character of each byte."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return tuple(out)


@lru_cache(maxsize=None)
def _bytes(codec: str) -> dict[int, int]:
    back = {ord(c): b for b, c in enumerate(_chars(codec))}
    if codec == "cp1252":  # both readings of 0x80-0x9f occur in one text
        back |= {b: b for b in range(0x80, 0xA0) if b not in back}
    return back


def garble(word: str, chain: tuple[str, ...]) -> str:
    for codec in chain:
        table = _chars(codec)
        word = "".join(table[b] for b in word.encode("utf-8", "surrogatepass"))
    return word


def chains(depth: int = DEPTH) -> list[tuple[str, ...]]:
    out, last = [], [()]
    for _ in range(depth):
        last = [(*c, x) for c in last for x in CODECS]
        out += last
    return out


def _ranges(codes: set[int]) -> str:
    """A character class in as few ranges as there are: regular expressions try one after the other."""
    starts = [c for c in sorted(codes) if c - 1 not in codes]
    ends = [c for c in sorted(codes) if c + 1 not in codes]
    return "[" + "".join(f"\\u{a:04x}" if a == b else f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends)) + "]"


def _codes(codec: str, lo: int, hi: int) -> set[int]:
    own = {ord(_chars(codec)[b]) for b in range(lo, hi)}
    return own | set(range(0x80, 0xA0)) if codec == "cp1252" and (lo, hi) == (0x80, 0xC0) else own


@lru_cache(maxsize=None)
def signature(codec: str) -> str:
    """A pattern of UTF-8's shape in a codec's characters; good for Java and Python."""
    tail, two, three, four = (_ranges(_codes(codec, lo, hi)) for lo, hi in ((0x80, 0xC0), (0xC2, 0xE0), (0xE0, 0xF0), (0xF0, 0xF5)))
    return f"(?:{two}{tail}|{three}{tail}{tail}|{four}{tail}{tail}{tail})"


#: One look at a character rules most of them out as first bytes.
SIGNATURE = r"(?![\x00-\x7f])(?=" + _ranges(set().union(*(_codes(c, 0xC2, 0xF5) for c in CODECS))) + ")(?:" + "|".join(signature(c) for c in CODECS) + ")"
SUSPICIOUS = f"{SIGNATURE}|{LEGACY_SHAPE}|[\\u0080-\\u009f]"
#: A character that every suspicious text has: a byte after the first of one of UTF-8's, or from the upper half of Latin-1. The ranges of plain letters come first, to be ruled out fast.
NEEDED = r"(?![\x00-\x7f\u0100-\u0151\u0620-\u0652])" + _ranges(set(range(0x80, 0xA0)) | set(range(0xA1, 0x100)).union(*(_codes(c, 0x80, 0xC0) for c in CODECS)))
_LEGACY, _CONTROL, _LATIN = re.compile(LEGACY_SHAPE), re.compile("[\x80-\x9f]"), re.compile("[A-Za-zÀ-ÿ]")


@lru_cache(maxsize=None)
def _runs(codec: str) -> re.Pattern:
    return re.compile(f"(?:{signature(codec)})+")


def _undo(text: str, codec: str) -> str:
    """``text`` with its runs of UTF-8's shape decoded once; the same text if there are none."""

    def one(m: re.Match) -> str:
        try:
            return bytes(map(_bytes(codec).__getitem__, map(ord, m.group()))).decode("utf-8")
        except (UnicodeDecodeError, KeyError):
            return m.group()

    return _runs(codec).sub(one, text)


def hypotheses(word: str, known: set[str], depth: int = DEPTH) -> list[str]:
    """Originals of a word, all of known letters and without further signs of garbling; most decoded first."""
    found, level = [], [word]
    for _ in range(depth):
        level = list(dict.fromkeys(x for w in level for c in CODECS if (x := _undo(w, c)) != w))
        found = [x for x in level if known.issuperset(x)] + found
    for written, read in LEGACY:
        if _CONTROL.search(word) if written == "cp1252" else _LEGACY.fullmatch(word):
            try:
                x = word.encode(read).decode(written)
            except UnicodeError:
                continue
            if x != word and known.issuperset(x) and not (written == "cp1256" and _LATIN.search(x)):
                found.append(x)
    clean = [x for x in dict.fromkeys(found) if not any(known.issuperset(y) for c in CODECS if (y := _undo(x, c)) != x)]
    return clean or found[:1]


def _forms(text: str) -> set[str]:
    """All garbled forms of a word; ASCII runs within it are the same in all."""
    out = {garble(text, c) for c in chains()}
    for written, read in LEGACY:
        try:
            out.add(text.encode(written).decode(read))
        except UnicodeError:
            pass
    return out - {text}


def suspicious(text: Column) -> Column:
    return text.rlike(NEEDED) & text.rlike(SUSPICIOUS)


def words(texts: DataFrame, column: str) -> DataFrame:
    """(token, n): the distinct words of ``texts`` that hold more than ASCII.

    Runs between blanks are counted first, so that only distinct ones are searched for words.
    """
    beyond = r"[^\x00-\x7f]"
    # explode_outer: for explode the planner adds a filter that splits every text again.
    runs = texts.filter(F.col(column).rlike(beyond)).select(F.explode_outer(F.split(column, " ")).alias("run")).groupBy("run").agg(F.count("*").alias("n")).filter(F.col("run").rlike(beyond))
    found = runs.select(F.explode_outer(F.regexp_extract_all("run", F.lit(WORD), F.lit(0))).alias("token"), "n").filter(F.col("token").rlike(beyond))
    return stage(found.groupBy("token").agg(F.sum("n").alias("n")), "tokens")


def originals(tokens: DataFrame) -> DataFrame:
    """(token, original): what to put for each garbled word of ``tokens``."""
    odd = suspicious(F.col("token"))
    marked = stage(tokens.withColumn("odd", odd), "marked")
    letters = marked.filter("NOT odd").select(F.explode(F.array_distinct(F.split("token", ""))).alias("c")).groupBy("c").count()
    known = {r.c for r in letters.filter("c <> ''").collect()}  # at most as many rows as there are characters
    known = (known - {LOST}) | set(map(chr, range(128)))
    shared = tokens.sparkSession.sparkContext.broadcast(known)

    def guess(batches):
        for pdf in batches:
            rows = [(t, o) for t in pdf["token"] for o in hypotheses(t, shared.value)]
            yield pd.DataFrame(rows, columns=["token", "original"])

    suspects = marked.filter(F.col("odd") & ~F.col("token").contains(LOST)).select("token")
    guesses = stage(suspects.mapInPandas(guess, "token string, original string"), "guesses")
    clean = marked.join(guesses.select("token").distinct(), "token", "left_anti").select(F.col("token").alias("original"), "n")
    vocabulary = clean.unionByName(guesses.select("original", F.lit(0).cast("long").alias("n"))).groupBy("original").agg(F.max("n").alias("n"))

    def garbled(batches):
        for pdf in batches:
            rows = [(g, o, n) for o, n in zip(pdf["original"], pdf["n"]) for g in _forms(o)]
            yield pd.DataFrame(rows, columns=["token", "original", "n"]).astype({"n": "int64"})

    # Garbling costs far more than its bytes tell, so the words are spread over all tasks and not by size.
    parts = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = vocabulary.repartition(parts).mapInPandas(garbled, "token string, original string, n long")
    rank = Window.partitionBy("token").orderBy(F.desc("n"), "original")
    return table.join(suspects, "token").withColumn("r", F.row_number().over(rank)).filter("r = 1").select("token", "original")


def masked_ends(rows: DataFrame, tokens: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the rows with a word that is some clean word with its last letters as question marks."""
    mask = tokens.filter(~suspicious(F.col("token"))).select(F.regexp_replace("token", r"[^\x00-\x7f]", "?").alias("_end"))
    ends = mask.filter(F.col("_end").rlike(r"^[A-Za-z]+\?+$")).distinct()
    shape = r"(?<![\p{L}\p{M}?-])[A-Za-z]+\?+(?![\p{L}\p{M}?])"
    there = rows.filter(F.col("_text").rlike(r"[A-Za-z]\?")).select(*keys, F.explode_outer(F.regexp_extract_all("_text", F.lit(shape), F.lit(0))).alias("_end"))
    return there.join(ends, "_end", "left_semi").select(*keys).distinct()


def restore(texts: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(*keys, restored) for each row whose text is garbled as a whole or in part.

    ``restored`` is the whole text as it was, or ``''`` where letters were lost:
    replacement characters, or question marks in place of letters. Null and empty
    texts are never garbled. ``keys`` must be unique together; a row whose keys
    repeat exactly gives one result. Texts of any length are handled whole. Other
    columns are ignored.
    """
    rows = texts.select(*keys, F.col(column).alias("_text")).filter(F.col("_text") != "")
    lost = F.col("_text").contains(LOST) | (F.col("_text").contains("?") & F.col("_text").rlike(LOST_MARKS))
    masked = F.col("_text").contains("?") & F.col("_text").rlike(r"[A-Za-z]\?")
    # Whatever may be a case, found in one pass; all words are taken in another.
    # Generated, as the planner would push a filter on plain columns down and compute them twice.
    flags = F.explode_outer(F.array(F.struct(lost.alias("_lost"), masked.alias("_masked"), suspicious(F.col("_text")).alias("_odd")))).alias("f")
    cases = rows.select("*", flags).filter("f._lost OR f._masked OR f._odd").select(*keys, "_text", "f.*")
    cases = stage(cases.dropDuplicates(keys), "cases")
    tokens = words(rows, "_text")
    ended = stage(masked_ends(cases.filter("_masked AND NOT _lost"), tokens, keys), "ended")
    gone = cases.filter("_lost").select(*keys).unionByName(ended).withColumn("restored", F.lit(""))
    mapping = stage(originals(tokens), "originals")
    odd = cases.filter("_odd AND NOT _lost").join(ended, keys, "left_anti")
    parts = odd.select(*keys, F.posexplode_outer(F.regexp_extract_all("_text", F.lit(SEGMENT), F.lit(0))).alias("_pos", "_seg"))
    fixed = (
        parts.join(mapping, F.col("_seg") == F.col("token"), "left")
        .groupBy(*keys)
        .agg(
            F.max(F.col("token").isNotNull()).alias("_hit"),
            F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("original", "_seg").alias("s")))).alias("_parts"),
        )
        .filter("_hit")
        .select(*keys, F.concat_ws("", F.transform("_parts", lambda p: p["s"])).alias("restored"))
    )
    return fixed.unionByName(gone)
