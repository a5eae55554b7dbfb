"""Lookup tables of patterns, weights and forms, and providers for what lives outside the engine."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import lookup

# Names of patterns.
PATTERNS = {
    "فَعلان": "faʿlān",
    "فَعيلٌ": "faʿīl",
    "استفعل": "istafʿal",
    "فَعول": "faʿūl",
    "فُعُّول": "fuʿūl",
    "فَعَلَ": "faʿala (verb)",
    "أفْعَلَ": "afʿala (verb)",
    "فَعَّلَ": "faʿʿala (verb)",
    "فَاعَلَ": "fāʿala (verb)",
}
# Weights of the verb stems by their number, as it is spelled.
WEIGHTS = {
    "1": "فَعَلَ",
    "2": "فَاعَلَ",
    "3": "فَعَّلَ",
    "4": "أَفْعَلَ",
    "5": "تَفَعَّلَ",
    "6": "تَفَاعَلَ",
    "7": "انْفَعَلَ",
    "8": "افْتَعَلَ",
    "9": "افْعَلَّ",
    "10": "اسْتَفْعَلَ",
    "11": "افْعَالَّ",
    "12": "افْعَوَلَ",
    "13": "افْعَوَّلَ",
    "Q. 1": "فَعْلَلَ",
    "Q.1": "فَعْلَلَ",
    "Q. 2": "تَفَعْلَلَ",
    "Q.2": "تَفَعْلَلَ",
    "Q. 3": "افْعَنْلَلَ",
    "Q. 4": "افْعَلَلَّ",
    "Q. Q. 1": "فَعْلَلَ",
    "Q. Q. 2": "تَفَعْلَلَ",
    "Q. Q. 3": "افْعَنْلَلَ",
    "Q. Q. 4": "افْعَلَلَّ",
    "Q. Q.2": "تَفَعْلَلَ",
    "R. Q. 1": "فَعْلَلَ",
    "R. Q. 2": "تَفَعْلَلَ",
    "R. Q. 3": "افْعَنْلَلَ",
    "R. Q. 4": "افْعَلَلَّ",
    "R. Q.1": "فَعْلَلَ",
    "R.Q.1": "فَعْلَلَ",
}
# Form numbers; the last is accepted with either alif.
FORMS = {
    "المصدر": "1",
    "اسم_الفاعل": "2",
    "اسم_المفعول": "3",
    "اسم_المكان": "4",
    "اسم_الحال": "5",
    "اسم_الآلة": "6",
    "اسم_ذات": "7",
    "اسم_المبالغة": "8",
    "أسم_العلة": "9",
    "اسم_العلة": "9",
}


def pattern_name(c: Column) -> Column:
    return lookup(c, PATTERNS, F.lit("UNKNOWN"))


def weight_of(itype: Column, table: dict[str, str] = WEIGHTS, any_spelling: bool = False) -> Column:
    """The weight of a stem number such as 4, Q. 2 or R.Q.1; null for others.

    Numbers are matched as the table spells them; with ``any_spelling`` those of
    four-letter stems may have blanks anywhere. ``table`` may be another.
    """
    found = lookup(itype, table)
    if not any_spelling:
        return found
    tight = {k.replace(" ", ""): w for k, w in table.items() if "Q" in k}
    return F.coalesce(found, lookup(F.regexp_replace(itype, r"\s", ""), tight))


def form_number(label: Column) -> Column:
    """The number of a form's name, with spaces or underscores; null for others."""
    return lookup(F.replace(F.trim(label), F.lit(" "), F.lit("_")), FORMS).cast("int")


def token_count(c: Column, count: Callable[[str], int] | None = None) -> Column:
    """Tokens of a text: by a given tokenizer, or words and signs."""
    if count is None:
        return F.size(F.regexp_extract_all(c, F.lit(r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]"), F.lit(0)))

    @F.pandas_udf(T.LongType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else count(x))

    return run(c)


def analyses(c: Column, analyse: Callable[[str], list[str]]) -> Column:
    """The patterns a morphological analyser gives a word, ['NA'] for none; to be exploded."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: (analyse(x) if x is not None else []) or ["NA"])

    return run(c)


def clean_filename(c: Column) -> Column:
    return F.upper(F.trim(F.translate(c, "\r\n", "")))


def code_points(c: Column) -> Column:
    """The signs of a name in hexadecimal, to see what cannot be seen."""
    return F.concat_ws(" ", F.transform(F.split(c, ""), lambda x: F.hex(F.ascii(x))))
