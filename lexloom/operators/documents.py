"""Documents: conversations grouped from files, tables of contents, markup, schemas and differences."""

from __future__ import annotations

import json
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def set_key(names: Column) -> Column:
    return F.concat_ws(",", F.array_sort(names))


def conversation_docs(rows: DataFrame, conv: str, stamp: str, by_year: bool = False) -> DataFrame:
    """First time, date parts and number of messages of each conversation, or of each of its years; UTC."""
    when = F.timestamp_millis(F.col(stamp))
    keys = [conv, "year"] if by_year else [conv]
    per = rows.withColumn("year", F.year(when)).groupBy(*keys).agg(F.min(stamp).alias("conversation_start"), F.count("*").alias("n_messages"))
    start = F.timestamp_millis("conversation_start")
    return per.select("*", F.month(start).alias("month"), F.dayofmonth(start).alias("day"), F.hour(start).alias("hour"), F.date_format(start, "EEEE").alias("weekday"))


def fill_headers(lines: DataFrame, group: str, order: str, header: Column) -> DataFrame:
    """``lines`` with ``header``: the last header at or before each line of its group."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("header", F.last(header, ignorenulls=True).over(w))


def xml_text(column: Column) -> Column:
    """All texts of a fragment, trimmed and joined by '; '; null if it is not well formed."""

    @F.pandas_udf("string")
    def texts(s: pd.Series) -> pd.Series:
        def one(x):
            try:
                return "; ".join(t.strip() for t in ElementTree.fromstring(x).itertext() if t.strip())
            except (ElementTree.ParseError, TypeError):
                return None

        return s.map(one)

    return texts(column)


def xml_entry(column: Column) -> Column:
    """Struct(id, key, type, forms, texts) of a dictionary entry; '' for attributes that are not there, all null if it is not well formed.

    Forms are the texts of form/orth, texts all texts, trimmed and joined by '; '.
    """

    @F.pandas_udf("id string, key string, type string, forms string, texts string")
    def entry(s: pd.Series) -> pd.DataFrame:
        def one(x):
            try:
                root = ElementTree.fromstring(x)
            except (ElementTree.ParseError, TypeError):
                return (None,) * 5
            forms = (t for e in root.iterfind(".//form/orth") if (t := (e.text or "").strip()))
            texts = (t for x in root.itertext() if (t := x.strip()))
            return *(root.get(k, "") for k in ("id", "key", "type")), "; ".join(forms), "; ".join(texts)

        return pd.DataFrame([one(x) for x in s], columns=["id", "key", "type", "forms", "texts"])

    return entry(column)


class _Markdown(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.out: list[str] = []
        self.href: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "a":
            self.href.append(dict(attrs).get("href") or "")
            self.out.append("[")
        else:
            self.out.append({"p": "\n\n", "div": "\n\n", "br": "  \n", "li": "\n* ", "strong": "**", "b": "**", "em": "*", "i": "*", "code": "`"}.get(tag, ""))

    def handle_endtag(self, tag):
        if tag == "a" and self.href:
            self.out.append(f"]({self.href.pop()})")
        else:
            self.out.append({"strong": "**", "b": "**", "em": "*", "i": "*", "code": "`"}.get(tag, ""))

    def handle_data(self, data):
        self.out.append(data)


def to_markdown(html: Column) -> Column:
    @F.pandas_udf("string")
    def convert(s: pd.Series) -> pd.Series:
        def one(x):
            if x is None:
                return None
            p = _Markdown()
            p.feed(x)
            return "".join(p.out).strip()

        return s.map(one)

    return convert(html)


def flatten_mapping(mapping: dict, path: str = "") -> list[tuple[str, str, str]]:
    """(path, type, settings as JSON) of an index mapping's properties and multi-fields, depth first; type n/a if none is given."""
    out = []
    for part in ("properties", "fields"):
        for name, spec in (mapping.get(part) or {}).items():
            here = f"{path}.{name}" if path else name
            rest = {k: v for k, v in spec.items() if k not in ("type", "properties", "fields")}
            out.append((here, spec.get("type", "n/a"), json.dumps(rest, sort_keys=True, ensure_ascii=False)))
            out += flatten_mapping(spec, here)
    return out


def deep_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, field, left_value, right_value) of fields that differ; arrays compare without order, ids on one side only are skipped."""
    shared = [c for c in left.columns if c in right.columns and c != key]

    def canon(df: DataFrame, c: str) -> Column:
        kind = df.schema[c].dataType.typeName()
        return F.to_json(F.array_sort(c)) if kind == "array" else F.to_json(F.struct(c)) if kind in ("map", "struct") else F.col(c).cast("string")

    a = left.select(key, *[canon(left, c).alias(f"_l_{c}") for c in shared])
    b = right.select(key, *[canon(right, c).alias(f"_r_{c}") for c in shared])
    entries = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"_l_{c}").alias("left_value"), F.col(f"_r_{c}").alias("right_value")) for c in shared])
    return a.join(b, key).select(key, F.explode(F.filter(entries, lambda e: ~e["left_value"].eqNullSafe(e["right_value"]))).alias("e")).select(key, "e.*")


def contents_rows(lines: DataFrame, order: str, line: str, file: str | None = None) -> DataFrame:
    """(chapter_no, chapter, section, path) of a table of contents: lines that begin with '-' are sections of the chapter above.

    Raises nothing for a section before any chapter: its chapter is null, for the
    caller to reject. Blank lines are skipped. ``file`` tells several tables of
    contents apart; one of them is one task.
    """
    text = F.trim(line)
    rows = lines.filter(text != "").select(F.col(order).alias("o"), text.alias("t"), (F.col(file) if file else F.lit(0)).alias("g"))
    head = F.when(~F.col("t").startswith("-"), F.struct("o", "t"))
    filled = fill_headers(rows, "g", "o", head)
    title = lambda c: F.trim(F.replace(F.replace(c, F.lit(","), F.lit("")), F.lit("/"), F.lit(" or ")))
    numbered = filled.withColumn("chapter_no", F.dense_rank().over(Window.partitionBy("g").orderBy("header.o")))
    section = F.when(F.col("t").startswith("-"), title(F.regexp_replace("t", "^-+", "")))
    chapter = title(F.col("header.t"))
    return numbered.select(*([F.col("g").alias(file)] if file else []), "chapter_no", chapter.alias("chapter"), section.alias("section"), F.concat_ws("/", chapter, section).alias("path"))


def nested_rows(pages: DataFrame, *levels: str) -> DataFrame:
    """Nested arrays of structs flattened level by level, parents kept as prefixed columns."""
    df = pages
    for level in levels:
        rest = [c for c in df.columns if c != level]
        opened = df.select(*rest, F.explode_outer(level).alias("_e"))
        inner = opened.schema["_e"].dataType.fieldNames()
        df = opened.select(*[F.col(c) for c in rest], *[F.col(f"_e.{f}").alias(f if f not in rest else f"{level}_{f}") for f in inner])
    return df
