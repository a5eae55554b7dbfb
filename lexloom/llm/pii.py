"""Personal data in free text: found by the tagger, checked, replaced.

Each distinct text is labelled once. A span the tagger finds is then checked: its
ends are moved to those of the written form of its kind that it overlaps, and a
span that overlaps none is kept only if its kind has no written form or it is as
it stands a plausible e-mail address or address. The check never adds a span of its own.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tagger import Tagger
from .train_tagger import WEIGHTS

_AT = r"(?: ?@ ?| ?\(at\) ?| ?\[at\] ?| at )"
_DOT = r"(?:\.| ?\[dot\] ?| ?\(dot\) ?| dot )"
_N = r"[0-9٠-٩]"
_L = r"[^\W\d_]"
_NAME = r"(?:[^\W\d_]|[̀-ͯ¡-¿‐-⁄€™\u0080-\u009fˆ˜])"
#: The written forms of each kind.
FORMS = {
    "email": re.compile(rf"[A-Za-z0-9][A-Za-z0-9._+-]*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*{_DOT}[A-Za-z]{{2,}}"),
    "phone": re.compile(rf"(?:\+ ?)?(?:\({_N}+\)|{_N}+)(?:[ .-]?(?:\({_N}+\)|{_N}+))*"),
    "id_number": re.compile(rf"[A-Z]{{0,2}}{_N}+(?:[ -]{_N}+)*(?: ?[A-Z]\b)?"),
    "address": re.compile(
        rf"{_N}+[a-z]?,? (?:rue|avenue|boulevard|place|chemin)(?: (?:de la|du|des|de|d'))* ?{_L}+"
        rf"|(?:Calle|C/|Avenida|Plaza|Paseo) (?:(?:de|del|la|las|los) )*{_L}+(?:,| nº| n°)? {_N}+[a-z]?"
        rf"|شارع {_L}+ {_N}+"
        rf"|{_N}+[a-z]? {_L}+(?: {_L}+)? (?:St\.|Rd\.|Ave\.|Lane|Avenue|Ave|Road|Rd|Street|St|Court|Square|Way)"
    ),
}
_WHOLE_NAME = re.compile(r"\S+(?: \S+)+")
_EDGE = " \n\t.,;:!?\"'()[]<>-–—،؛؟"
TITLES = ("Dr. ", "Dr ", "Mr. ", "Mrs. ", "Ms. ", "Mme ", "M. ", "Prof. ", "Sr. ", "Sra. ")
NOT_PERSONS = ("Jidhr Study Desk",)


@lru_cache(maxsize=1)
def tagger() -> Tagger:
    with np.load(WEIGHTS) as w:
        return Tagger(weights=dict(w))


#: What a span of no known form must look like as a whole.
PLAUSIBLE = {"email": re.compile(rf"[^\s@]+{_AT}[^\s@]+(?:{_DOT}[^\s@]+)*{_DOT}{_L}{{2,}}"), "address": re.compile(rf"(?=.*{_N})(?=.*{_L}{{2}})\S+(?: \S+)+")}


def _as_it_stands(text: str, kind: str, lo: int, hi: int) -> tuple[str, int, int] | None:
    """A span of no known form, without the signs around it; None if it is not plausible."""
    while lo < hi and text[lo] in _EDGE:
        lo += 1
    while hi > lo and text[hi - 1] in _EDGE:
        hi -= 1
    return (kind, lo, hi) if kind in PLAUSIBLE and PLAUSIBLE[kind].fullmatch(text[lo:hi]) else None


def check(text: str, kind: str, lo: int, hi: int) -> tuple[str, int, int] | None:
    """A span with its ends set right; None if it can be no such thing."""
    if kind == "person":
        # A name ends where the words it touches end.
        while lo > 0 and not text[lo - 1].isspace() and text[lo - 1] not in _EDGE:
            lo -= 1
        while hi < len(text) and not text[hi].isspace() and text[hi] not in _EDGE:
            hi += 1
        while lo < hi and text[lo] in _EDGE:
            lo += 1
        while hi > lo and text[hi - 1] in _EDGE:
            hi -= 1
        for t in TITLES:
            if text.startswith(t, lo):
                lo += len(t)
        name = text[lo:hi]
        if not _WHOLE_NAME.fullmatch(name) or any(n in name or name in n for n in NOT_PERSONS) or any(c.isdigit() for c in name):
            return None
        return kind, lo, hi
    near = max(0, lo - 40)
    best = None
    for m in FORMS[kind].finditer(text, near):
        if m.start() >= hi:
            break
        shared = min(hi, m.end()) - max(lo, m.start())
        if shared > 0 and (best is None or shared > best[0]):
            best = (shared, m.start(), m.end())
    if best is None:
        return _as_it_stands(text, kind, lo, hi)
    if best[0] * 2 < hi - lo:
        return None
    lo, hi = best[1:]
    digits = sum(c.isdigit() for c in text[lo:hi])
    if kind == "phone" and not 7 <= digits <= 16 or kind == "id_number" and digits < 7:
        return None
    return kind, lo, hi


def spans(texts: list[str]) -> list[list[tuple[str, int, int]]]:
    out = []
    for text, found in zip(texts, tagger().tag(texts)):
        kept: list[tuple[str, int, int]] = []
        for kind, lo, hi in found:
            s = check(text, kind, lo, hi)
            if s and not (kept and s[1] < kept[-1][2]):
                kept.append(s)
        out.append(kept)
    return out


def text_keys(column: str) -> list[Column]:
    """Two hashes of a text, _a and _b, that stand for it in joins: 128 bits in place of all its letters."""
    return [F.xxhash64(column).alias("_a"), F.xxhash64(F.lit(1), column).alias("_b")]


def _distinct(texts: DataFrame, column: str) -> DataFrame:
    """Every text that is not blank, once, spread over all tasks: what tagging costs isn't told by its bytes."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.select(F.col(column).alias("_text")).filter(F.col("_text").rlike(r"\S")).distinct().repartition(parts)


def _joined(texts: DataFrame, column: str, found: DataFrame) -> DataFrame:
    keyed = found.select(*text_keys("_text"), *[c for c in found.columns if c != "_text"])
    return texts.select("*", *text_keys(column)).join(keyed, ["_a", "_b"]).drop("_a", "_b")


def find_personal(texts: DataFrame, column: str) -> DataFrame:
    """``texts`` with (start, end, pii_kind, val) of every span of its ``column``, one row a span.

    Null and blank texts have none. Texts of any length are read whole, each distinct
    one once. The four names are reserved among the columns of ``texts``, with _a and
    _b. An empty table gives an empty result.
    """

    def run(batches):
        for pdf in batches:
            found = pdf["_text"].tolist()
            rows = [(t, lo, hi, k, t[lo:hi]) for t, s in zip(found, spans(found)) for k, lo, hi in s]
            yield pd.DataFrame(rows, columns=["_text", "start", "end", "pii_kind", "val"]).astype({"start": "int32", "end": "int32"})

    return _joined(texts, column, _distinct(texts, column).mapInPandas(run, "_text string, start int, end int, pii_kind string, val string"))


def redact(texts: DataFrame, column: str) -> DataFrame:
    """The rows of ``texts`` whose ``column`` holds personal data, with ``redacted``: the text with placeholders such as <EMAIL>."""

    def run(batches):
        for pdf in batches:
            rows = []
            for t, s in zip(pdf["_text"], spans(pdf["_text"].tolist())):
                if s:
                    parts, at = [], 0
                    for kind, lo, hi in s:
                        parts += [t[at:lo], f"<{kind.upper()}>"]
                        at = hi
                    rows.append((t, "".join([*parts, t[at:]])))
            yield pd.DataFrame(rows, columns=["_text", "redacted"])

    return _joined(texts, column, _distinct(texts, column).mapInPandas(run, "_text string, redacted string"))
