"""Files of the kinds lexical data comes in, as frames. Readers keep file order as ``ordinal`` where order means anything."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.numbering import number_rows, number_within


def require(df: DataFrame, *columns: str) -> DataFrame:
    """``df``; raises ValueError naming the columns it lacks."""
    if missing := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def _place() -> Column:
    """Where a row stands: file, block of the file, and the reader's running number within it."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def read_csv(spark: SparkSession, path: str | list[str], *required: str, sep: str = ",", schema: str | None = None, place: str | None = None) -> DataFrame:
    """Header CSV in UTF-8, with or without a byte order mark, quoted fields over several lines; all strings unless a schema is given.

    ``place`` names a column to be added that orders rows as they stand in their files.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("sep", sep)
    rows = require((reader.schema(schema) if schema else reader).csv(path), *required)
    return rows.select("*", _place().alias(place)) if place else rows


def tolerant(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows whose key is a whole number; of a repeated key the last by ``order``, such as the ``place`` of a row."""
    good = df.withColumn(key, F.col(key).try_cast("long")).filter(F.col(key).isNotNull())
    last = Window.partitionBy(key).orderBy(F.desc(order))
    return good.withColumn("_r", F.row_number().over(last)).filter("_r = 1").drop("_r")


def existing(spark: SparkSession, paths: list[str]) -> tuple[list[str], list[str]]:
    """Of the paths, those that are there, and those that are not."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = [p for p in paths if (q := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(q)]
    return there, [p for p in paths if p not in there]


def read_numbered(spark: SparkSession, pattern: str, count: int, skip_missing: bool = False) -> DataFrame:
    """Lines of pattern.format(1..count), with the number of their file; a missing file is an error unless skipped."""
    there, missing = existing(spark, [pattern.format(i) for i in range(1, count + 1)])
    if missing and not skip_missing:
        raise FileNotFoundError(missing[0])
    if not there:
        return spark.createDataFrame([], "line string, file_no int")
    left, right = (re.escape(x) for x in pattern.rsplit("/", 1)[-1].split("{}"))
    number = F.regexp_extract(F.col("_metadata.file_name"), f"{left}([0-9]+){right}", 1).try_cast("int")
    return spark.read.text(there).select(F.col("value").alias("line"), number.alias("file_no"))


def read_preamble_tsv(spark: SparkSession, path: str, preamble: int, schema: str) -> DataFrame:
    """A header TSV after ``preamble`` lines, with ``ordinal`` from 1. One file; lines are numbered by their places."""
    lines = number_rows(spark.read.text(path).select("value", _place().alias("place")), ["place"], "i")
    body = lines.filter(F.col("i") > preamble + 1)
    return body.select((F.col("i") - preamble - 1).alias("ordinal"), F.from_csv("value", schema, {"sep": "\t"}).alias("r")).select("ordinal", "r.*")


def read_verses(spark: SparkSession, path: str) -> DataFrame:
    """sura/@index,@name with aya/@index,@text as rows."""
    schema = "_index int, _name string, aya array<struct<_index:int,_text:string>>"
    suras = spark.read.format("xml").option("rowTag", "sura").schema(schema).load(path)
    return suras.select(F.col("_index").alias("sura_index"), F.col("_name").alias("sura_name"), F.explode("aya").alias("a")).select("sura_index", "sura_name", F.col("a._index").alias("aya_index"), F.col("a._text").alias("text"))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """(title, body) of every item of a feed."""
    schema = T.StructType([T.StructField("title", T.StringType()), T.StructField("content:encoded", T.StringType())])
    items = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)
    return items.select("title", F.col("`content:encoded`").alias("body"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, line_number, line): stripped lines without the blank ones, which count. A file may lie in many tasks."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file_name"), F.trim("value").alias("line"), _place().alias("place"))
    return number_within(lines, ["file_name"], ["place"], "line_number").filter("line <> ''").select("file_name", "line_number", "line")


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("text"), F.col("_metadata.file_name").alias("file_name"))


CONVERSATION = "participants array<struct<name:string>>, messages array<struct<sender_name:string,timestamp_ms:bigint,content:string>>"


def read_conversations(spark: SparkSession, directory: str) -> DataFrame:
    """Every JSON file of a directory that has participants."""
    return spark.read.schema(CONVERSATION).option("multiLine", True).json(directory).filter(F.col("participants").isNotNull())


def read_keyed_json(spark: SparkSession, path: str, schema: str, key: str = "id") -> DataFrame:
    """A JSON array of objects, one row a key: the last."""
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select("*", _place().alias("_place"))
    last = F.max_by(F.struct(*[c for c in rows.columns if c != "_place"]), "_place")
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(last.alias("_r")).select("_r.*")


def dropna(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a value in all of ``columns``; a plain filter, which reaches the scan."""
    return df.filter(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns)))
