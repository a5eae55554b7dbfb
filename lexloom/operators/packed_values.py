"""Several values packed in one field: one row per value, position kept.

A *dialect* is a set of delimiters plus the choice whether quotes protect what
they enclose. Every field is parsed under each dialect its characters allow and
the parse with the minimum description length wins. Code lengths come from the
whole table: labels and values are counted over all parses of all fields
(pre-aggregated per batch, summed by Spark), a token seen with share p costs
-log2 p bits, an unseen one is spelled out letter by letter. Entries repeat from
field to field, so what one costs is remembered within a task.

The code table keeps tokens with a share of at least 2**-SHARE_BITS. Shares of
labels add up to one, as do those of values, so it holds at most
2 * 2**SHARE_BITS rows at any input size; that is the bound under which it is
sent to the executors.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

DELIMITERS = (",", ";", "،", "؛", "|", "\t", "\n")
SHARE_BITS = 15
LETTER_BITS = 6.5
ESCAPE_BITS = 4.0
SIGN_BITS = 8.0
BLANKS = " \t\n\r\f\v\u00a0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


@lru_cache(maxsize=512)
def _grammar(delims: str) -> re.Pattern:
    cls = re.escape(delims) if delims else r"\x00"
    blank = "[" + "".join(re.escape(c) for c in BLANKS if c not in delims) + "]*"
    plain = rf"[^{cls}]*" if delims else r".*"
    ends = rf"(?={blank}(?:[{cls}]|\Z))"
    quoted = "|".join(
        (
            rf'"(?P<d>[^"]*+(?:""[^"]*+)*+)"{ends}',
            rf"'(?P<s>[^']*+(?:'(?!{blank}(?:[{cls}]|\Z))[^']*+)*+)'{ends}",
            rf"“(?P<c>[^”]*+)”{ends}",
            rf"«(?P<g>[^»]*+)»{ends}",
        )
    )
    label = rf"(?P<label>[^{cls}:=\"“«]*+[:=])?" if delims else r"(?P<label>[^:=\"“«]*+[:=])?"
    return re.compile(rf"{blank}{label}{blank}(?:{quoted}){blank}|(?P<plain>{plain})", re.S)


def _inner(m: re.Match) -> str:
    if (x := m.group("d")) is not None:
        return x.replace('""', '"')
    return next((x for x in (m.group("s"), m.group("c"), m.group("g")) if x is not None), "")


_SIGNS = re.compile("[" + "".join(DELIMITERS) + ":=\"“”«»]")
_SEPARATOR = re.compile(r"[:=]")
#: A quote where a value or an entry may begin; without one, quotes enclose nothing.
_OPENING = re.compile(r"(?:\A|[" + "".join(DELIMITERS) + ":=])[" + "".join(map(re.escape, BLANKS)) + "]*[\"'“«]")
#: Longer entries are not remembered, so that what a task remembers is bounded.
REMEMBERED, REMEMBERED_LENGTH = 1 << 16, 200


def _split_label(entry: str) -> tuple[str, str] | None:
    """(label, value) of an unquoted entry; None for a blank one."""
    m = _SEPARATOR.search(entry)
    if m:
        return entry[: m.start()].strip().lower(), entry[m.end() :].strip()
    entry = entry.strip()
    return ("", entry) if entry else None


_remembered_label = lru_cache(maxsize=REMEMBERED)(_split_label)


def _entry(text: str) -> tuple[str, str] | None:
    return _remembered_label(text) if len(text) <= REMEMBERED_LENGTH else _split_label(text)


@lru_cache(maxsize=512)
def _splitter(delims: str) -> re.Pattern:
    return re.compile("[" + re.escape(delims) + "]")


def _entries(field: str, delims: str, quotes: bool) -> Iterator[tuple[str, str]]:
    if not quotes:
        pieces = field.split(delims) if len(delims) == 1 else _splitter(delims).split(field) if delims else [field]
        yield from filter(None, map(_entry, pieces))
        return
    match, at, n = _grammar(delims).match, 0, len(field)
    while at <= n:
        m = match(field, at)
        if (plain := m["plain"]) is not None:
            e = _entry(plain)
        elif (label := m["label"]) is None:
            e = _entry(_inner(m))
        else:
            e = label[:-1].strip().lower(), _inner(m).strip()
        if e:
            yield e
        at = m.end() + 1


def parse(field: str, delims: str, quotes: bool) -> list[tuple[str, str]]:
    """The non-blank entries of ``field`` as (label, value) under one dialect."""
    return list(_entries(field, delims, quotes))


@lru_cache(maxsize=1024)
def _dialects(there: str, opening: bool) -> list[tuple[str, bool, str]]:
    """Every set of the delimiters present, fewest first but for all of them, with quotes on or off, and what it is called in the code."""
    n = len(there)
    sizes = [0, *([n] if n else []), *range(1, n)]
    sets = ["".join(c) for k in sizes for c in combinations(there, k)]
    names = {0: "none", n: "all", 1: "one", n - 1: "but one"} if n > 2 else {1: "one", 0: "none", n: "all"} if n else {0: "none"}
    if not opening:
        return [(s, False, names.get(len(s), "some")) for s in sets]
    return [(s, q, f"{names.get(len(s), 'some')}/{q}") for s in sets for q in (True, False)]


def _signs(field: str) -> tuple[str, bool]:
    """The delimiters present, and whether a quote may open."""
    return "".join(d for d in DELIMITERS if d in field), _OPENING.search(field) is not None


def dialects(field: str) -> list[tuple[str, bool, str]]:
    """(delimiters, whether quotes enclose, shape) of every dialect that may tell the field's signs apart."""
    return _dialects(*_signs(field))


def _spelled(token: str) -> float:
    """Bits of a token without a code: its letters, and more for each sign that should have split or enclosed it."""
    return ESCAPE_BITS + LETTER_BITS * (len(token) + 1) + SIGN_BITS * len(_SIGNS.findall(token))


class Coder:
    """Finds the parse of minimum description length under given code lengths."""

    def __init__(self, codes: dict[str, dict[str, float]]):
        self.codes = codes
        self.bits: dict[tuple[str, str], float] = {}
        self.orders: dict[tuple[str, bool], list[tuple[float, int, str, bool, str]]] = {}

    def _bits(self, entry: tuple[str, str]) -> float:
        label, value = entry
        code = self.codes["label"].get(label)
        bits = _spelled(label) + 8 if code is None else code
        code = self.codes["value"].get(value)
        bits += _spelled(value) if code is None else code
        if len(label) + len(value) <= REMEMBERED_LENGTH:
            if len(self.bits) >= REMEMBERED:
                self.bits.clear()
            self.bits[entry] = bits
        return bits

    def best(self, field: str) -> tuple[str, list[tuple[str, str]]]:
        """The shape of the cheapest dialect and its parse; the first of equals.

        Dialects with a short code come first, and a parse is left as soon as it
        costs more than the best so far, which changes no result.
        """
        signs = _signs(field)
        if signs not in self.orders:
            shapes = self.codes["shape"]
            self.orders[signs] = sorted((shapes.get(shape, 10.0), i, d, q, shape) for i, (d, q, shape) in enumerate(_dialects(*signs)))
        least, at, found, known = math.inf, 0, ("none", []), self.bits
        for cost, i, delims, quotes, shape in self.orders[signs]:
            if cost > least:
                break
            if not quotes and delims and (first := _entry(field[: _splitter(delims).search(field).start()])):
                if cost + (known.get(first) or self._bits(first)) > least:
                    continue
            entries = []
            for e in _entries(field, delims, quotes):
                cost += known.get(e) or self._bits(e)
                if cost > least:
                    break
                entries.append(e)
            else:
                if cost < least or cost == least and i < at:
                    least, at, found = cost, i, (shape, entries)
        return found


class Tally:
    """Counts of labels, values and dialect shapes.

    While there are no codes a field's parses by each single delimiter and by all of
    them count alike; then its best parse does, of all dialects.
    """

    def __init__(self):
        self.seen: dict[str, dict[str, float]] = {"shape": {}, "label": {}, "value": {}}

    def add(self, field: str, coder: Coder | None) -> None:
        if coder:
            parses = [coder.best(field)]
        else:
            kinds = [d for d in dialects(field) if d[2].split("/")[0] in ("all", "one")] or dialects(field)
            parses = [(shape, _entries(field, d, q)) for d, q, shape in kinds]
        part = 1 / len(parses)
        shapes, labels, values = self.seen["shape"], self.seen["label"], self.seen["value"]
        for shape, entries in parses:
            shapes[shape] = shapes.get(shape, 0) + part
            for label, value in entries:
                labels[label] = labels.get(label, 0) + part
                values[value] = values.get(value, 0) + part

    def rows(self) -> pd.DataFrame:
        return pd.DataFrame([(k, t, n) for k, counts in self.seen.items() for t, n in counts.items()], columns=["kind", "token", "n"]).astype({"n": "float64"})


def code_lengths(fields: DataFrame, column: str, rounds: int = 3) -> dict[str, dict[str, float]]:
    """Code lengths in bits of the labels, values and dialect shapes common enough to have one.

    The first round counts parses alike (see ``Tally``), each later one the best
    parses under the codes so far, so that fragments of wrong parses drop out.
    """
    spark = fields.sparkSession
    codes: dict[str, dict[str, float]] = {}
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(codes)

        def count(batches, shared=shared):
            coder = Coder(shared.value) if shared.value else None
            for pdf in batches:
                tally = Tally()
                for field in pdf[column]:
                    tally.add(field, coder)
                yield tally.rows()

        counts = fields.select(column).mapInPandas(count, "kind string, token string, n double").groupBy("kind", "token").agg(F.sum("n").alias("n"))
        total = F.sum("n").over(Window.partitionBy("kind"))
        rows = counts.withColumn("share", F.col("n") / total).filter((F.col("share") >= 2.0**-SHARE_BITS) & (F.col("n") > 1)).collect()
        codes = {kind: {r.token: -math.log2(r.share) for r in rows if r.kind == kind} for kind in ("label", "value", "shape")}
    return codes


def split_packed(df: DataFrame, key: str, column: str, nulls: tuple[str, ...] = ("NA",)) -> DataFrame:
    """One row (key, item_pos, attr, val) per non-blank entry of ``column``.

    Null, blank and ``nulls`` fields give no row, as do null keys' fields only if
    the field itself is empty: a null key is kept. Repeated (key, field) rows count
    once. An empty table gives an empty result. Other columns are ignored, so they
    may have any name. Fields of any length are parsed whole, in linear time.
    """
    text = F.col(f"`{column}`")
    given = df.select(F.col(f"`{key}`").alias("k"), text.cast("string").alias("packed")).filter(F.col("packed").rlike(r"\S") & ~F.trim(F.col("packed")).isin(*nulls))
    # Parsing costs far more than its bytes tell, so the fields are spread over all tasks and not by size.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = stage(given.dropDuplicates(["k", "packed"]).repartition(parts), "fields")
    shared = df.sparkSession.sparkContext.broadcast(code_lengths(fields, "packed"))
    kind = df.schema[key].dataType.simpleString()

    def entries(batches):
        coder = Coder(shared.value)
        for pdf in batches:
            rows = [(k, i, a, v) for k, field in zip(pdf["k"], pdf["packed"]) for i, (a, v) in enumerate(coder.best(field)[1], 1)]
            yield pd.DataFrame(rows, columns=["k", "item_pos", "attr", "val"]).astype({"k": pdf["k"].dtype})

    return fields.mapInPandas(entries, f"k {kind}, item_pos int, attr string, val string").withColumnRenamed("k", key).distinct()
