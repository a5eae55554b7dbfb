"""Column functions over words, roots, tags and free text. Column in, column out; all run in the JVM but for ``decompose``."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The mark ranges, the letters folded to one, and the Buckwalter transliteration.
WIDE_MARKS = "[ً-ٕ]"
NARROW_MARKS = "[ً-ْ]"
FOLD_FROM, FOLD_TO = "أإآىة", "ااايه"
BUCKWALTER = "'|>&<}AbptvjHxd*rzs$SDTZEg_fqklmnhwYyFNKaui~o`{"
ARABIC = "ءآأؤإئابةتثجحخدذرزسشصضطظعغـفقكلمنهوىيًٌٍَُِّْٰٱ"
ALPHABET = "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"
ROOT_CLASSES = {2: "Geminate", 3: "Triliteral", 4: "Quadriliteral", 5: "Quintiliteral", 6: "Hexaliteral", 7: "Heptaliteral"}


@F.pandas_udf(T.StringType())
def decompose(s: pd.Series) -> pd.Series:
    """NFKD; the engine has no built-in for it. Null stays null."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x))


def strip_marks(c: Column, wide: bool = True) -> Column:
    return F.regexp_replace(decompose(c), WIDE_MARKS if wide else NARROW_MARKS, "")


def fold_letters(c: Column) -> Column:
    return F.translate(c, FOLD_FROM, FOLD_TO)


def normalize_arabic(c: Column) -> Column:
    return fold_letters(strip_marks(c))


def strip_article(c: Column, alif: bool = False) -> Column:
    """A leading article, up to two marks and a doubling sign after it, and one mark at the end.

    By default what counts as an article is lām, with or without wasla alif before it,
    so a plain alif keeps it and any leading lām goes. With ``alif`` it is lām
    with or without either alif, if two signs follow, and all marks count.
    """
    article, marks = ("^[اٱ]?ل(?=.{2})", WIDE_MARKS) if alif else ("^ٱ?ل", NARROW_MARKS)
    out = F.regexp_replace(c, article, "")
    out = F.regexp_replace(out, f"^{marks}{{1,2}}", "")
    out = F.regexp_replace(out, "^\u0651", "")
    return F.regexp_replace(out, f"{marks}$", "")


def three_letters(root: Column) -> Column:
    """Struct(root, r3, r2, r1) of a root of exactly three signs, dashed; null for others, which are to be rejected."""
    r1, r2, r3 = (F.substring(root, i, 1) for i in (1, 2, 3))
    return F.when(F.length(root) == 3, F.struct(F.concat_ws("-", r1, r2, r3).alias("root"), r3.alias("r3"), r2.alias("r2"), r1.alias("r1")))


def to_arabic(c: Column) -> Column:
    return F.translate(c, BUCKWALTER, ARABIC)


def hyphenate(c: Column) -> Column:
    return F.concat_ws("-", F.split(c, ""))


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def nullify(c: Column, *sentinels: str) -> Column:
    return F.when(c.isin(*sentinels), None).otherwise(c)


def letter_at(index: Column, alphabet: str = ALPHABET) -> Column:
    """0-based; what is out of range shows as ?n."""
    letters = F.split(F.lit(alphabet), "")
    there = F.when((index >= 0) & (index < len(alphabet)), F.get(letters, index.cast("int")))
    return F.coalesce(there, F.concat(F.lit("?"), index.cast("string")))


def reconstruct_root(*radicals: Column, alphabet: str = ALPHABET) -> Column:
    """Letters joined by hyphens; null radicals are left out."""
    return F.concat_ws("-", *[F.when(r.isNotNull(), letter_at(r, alphabet)) for r in radicals])


def root_class(root: Column) -> Column:
    """By the number of different letters."""
    n = F.size(F.array_distinct(F.split(root, "-")))
    out = F.when(root.isNull(), None)
    for k, name in ROOT_CLASSES.items():
        out = out.when(n == k, name)
    return out.otherwise("BeyondSeptiliteral")


def radical_type(fourth: Column) -> Column:
    return F.when(fourth.isNull(), "Triliteral").otherwise("Quadriliteral")


def word_type(c: Column, verb_ending: str = "َ") -> Column:
    """Phrase for more than two words, Verb by the last sign, else Noun; null for empty."""
    n = F.size(words(c))
    return F.when(n == 0, None).when(n > 2, "Phrase").when(F.trim(c).endswith(verb_ending), "Verb").otherwise("Noun")


def classification_part(c: Column, i: int) -> Column:
    part = F.get(F.split(c, ","), F.lit(i))
    value = F.get(F.split(part, ": "), F.lit(1))
    return F.when(value.rlike(r"\p{L}"), value).otherwise("")


def split_class(c: Column, separator: str = "; ") -> Column:
    """Struct(cls, sub) of exactly two parts, NA as null; null if there are not two."""
    parts = F.split(c, separator)
    return F.when(F.size(parts) == 2, F.struct(nullify(parts[0], "NA").alias("cls"), nullify(F.get(parts, F.lit(1)), "NA").alias("sub")))


def parse_location(c: Column, parts: int = 4) -> Column:
    numbers = F.transform(F.split(F.regexp_replace(c, r"[()]", ""), ":"), lambda x: x.try_cast("int"))
    return F.when(F.size(numbers) == parts, numbers)


def feature_value(features: Column, key: str) -> Column:
    hits = F.filter(F.split(features, r"\|"), lambda t: t.startswith(key + ":"))
    return F.regexp_replace(F.get(hits, F.lit(0)), f"^{key}:", "")


def feature_flag(features: Column, flags: dict[str, str]) -> Column:
    """The name of the first flag that is a whole token."""
    tokens = F.split(features, r"\|")
    out = F.lit(None).cast("string")
    for token, name in reversed(flags.items()):
        out = F.when(F.array_contains(tokens, token), name).otherwise(out)
    return out


def ellipsis(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def clean_title(c: Column) -> Column:
    return F.trim(F.replace(F.replace(c, F.lit(","), F.lit("")), F.lit("/"), F.lit(" or ")))


def slug(c: Column, ending: str = ".md") -> Column:
    return F.concat(F.translate(c, " /", "__"), F.lit(ending))


def percent(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1)) * 100


def lookup(c: Column, table: dict[str, str], default: Column | None = None) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.try_element_at(pairs, c)
    return found if default is None else F.coalesce(found, default)
