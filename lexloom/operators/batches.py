"""Batches of work: fixed chunks, token budgets, what is left to do, requests and responses."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fixed_chunks(df: DataFrame, ordinal: str, size: int) -> DataFrame:
    """Chunk numbers from 1 by input ordinal (from 1); rejected rows keep their place, so chunks may be short."""
    return df.withColumn("chunk", F.expr(f"({ordinal} - 1) div {size} + 1"))


def budget_bins(df: DataFrame, group: str, ordinal: str, cost: str, most: int) -> DataFrame:
    """(group, ordinal, cost, bin): greedy bins in order; an item over the budget has its own.

    A running fold, so a group is one task, in which batches are folded as they stream
    in: the state is two numbers, and a bin's end is found by bisecting the running
    sums, so the work is one step a bin. Null costs count nothing.
    """
    kind = df.schema[group].dataType.simpleString()

    def one(costs: np.ndarray, b: int, total: int) -> tuple[np.ndarray, int, int]:
        sums, bins, i = costs.cumsum(), np.empty(len(costs), np.int32), 0
        while i < len(costs):
            base = (sums[i - 1] if i else 0) - total
            end = int(np.searchsorted(sums, base + most, "right"))  # the first item that goes beyond the budget
            before = (sums[end - 1] if end else 0) - base if end > i else total
            if end < len(costs) and before == 0:
                end += 1  # it is the first of its bin that costs anything
            bins[i:end] = b
            total = (sums[end - 1] if end else 0) - base if end > i else total
            if end < len(costs):
                b, total = b + 1, 0
                bins[end] = b
            i = end
        return bins, b, int(total)

    def fold(batches):
        at, b, total = None, 1, 0
        for pdf in batches:
            costs = pdf[cost].fillna(0).to_numpy(np.int64)
            out = np.empty(len(pdf), np.int32)
            changes = np.flatnonzero(pdf[group].ne(pdf[group].shift()).to_numpy())
            for lo, hi in zip(changes, [*changes[1:], len(pdf)]):
                if pdf[group].iloc[lo] != at:
                    at, b, total = pdf[group].iloc[lo], 1, 0
                out[lo:hi], b, total = one(costs[lo:hi], b, total)
            yield pdf.assign(bin=pd.Series(out, index=pdf.index))

    placed = df.filter(F.col(group).isNotNull()).select(group, ordinal, cost).repartition(group).sortWithinPartitions(group, ordinal)
    return placed.mapInPandas(fold, f"{group} {kind}, {ordinal} long, {cost} long, bin int")


def chunk_groups(df: DataFrame, ordinal: str, size: int = 500) -> DataFrame:
    """(chunk, n, first, last) of changes sent on in groups of ``size``."""
    return fixed_chunks(df, ordinal, size).groupBy("chunk").agg(F.count("*").alias("n"), F.min(ordinal).alias("first"), F.max(ordinal).alias("last"))


def finished(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """(chunk) of the outputs that lie in a directory already, by the number in their file names."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", pattern.replace("{}", "*")).load(directory).select(F.element_at(F.split("path", "/"), -1).alias("f"))
    left, right = (re.escape(x) for x in pattern.split("{}"))
    return names.select(F.regexp_extract("f", f"^{left}([0-9]+){right}$", 1).try_cast("long").alias("chunk")).filter("chunk IS NOT NULL").distinct()


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def requests(custom_id: Column, system: Column, user: Column, model: str = "stub", url: str = "/v1/chat/completions") -> Column:
    """A batch request as JSON text."""
    messages = F.array(F.struct(F.lit("system").alias("role"), system.alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content")))
    body = F.struct(F.lit(model).alias("model"), messages.alias("messages"))
    return F.to_json(F.struct(custom_id.alias("custom_id"), F.lit("POST").alias("method"), F.lit(url).alias("url"), body.alias("body")))


def stub_response(request: Column) -> Column:
    """The answer of a provider that echoes the user's text in capitals; for tests without a network."""
    text = F.upper(F.get_json_object(request, "$.body.messages[1].content"))
    choice = F.struct(F.struct(text.alias("content")).alias("message"))
    return F.to_json(F.struct(F.get_json_object(request, "$.custom_id").alias("custom_id"), F.struct(F.struct(F.array(choice).alias("choices")).alias("body")).alias("response")))


def response_rows(lines: DataFrame, column: str) -> DataFrame:
    """(ordinal, content): the number at the end of custom_id and the trimmed answer; malformed lines are left out."""
    cid = F.get_json_object(column, "$.custom_id")
    return lines.select(
        F.regexp_extract(cid, r"(\d+)$", 1).try_cast("long").alias("ordinal"),
        F.trim(F.get_json_object(column, "$.response.body.choices[0].message.content")).alias("content"),
    ).filter("ordinal IS NOT NULL AND content IS NOT NULL")


def json_fields(content: Column, *names: str) -> list[Column]:
    """Fields of a JSON answer as strings, '' where absent; all null if it is malformed."""
    parsed = F.from_json(content, ", ".join(f"{n} string" for n in names))
    whole = F.get_json_object(content, "$")
    return [F.when(whole.isNotNull(), F.coalesce(parsed[n], F.lit(""))).alias(n) for n in names]
