"""Pages by key, for tools that take a table piece by piece."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyset_page(df: DataFrame, key: str, size: int, after=None) -> DataFrame:
    """The ``size`` rows whose unique ``key`` comes next after ``after``; rows before it are skipped by statistics and not counted off."""
    rest = df.filter(F.col(key).isNotNull()) if after is None else df.filter(F.col(key) > after)
    return rest.orderBy(key).limit(size)


def pages(df: DataFrame, key: str, size: int) -> Iterator[DataFrame]:
    """All pages, one after the other."""
    after = None
    while True:
        page = keyset_page(df, key, size, after)
        last = page.agg(F.max(key)).first()[0]
        if last is None:
            return
        yield page
        after = last
