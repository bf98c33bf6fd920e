"""Projection, filtering, tagging and distribution of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtab.functions.text import is_page_request, split_parts


def with_length(df: DataFrame, col: str, name: str = "length") -> DataFrame:
    return df.withColumn(name, F.length(col).cast("bigint"))


def explode_split(df: DataFrame, col: str, sep: str, name: str = "word") -> DataFrame:
    """One row per part; the other columns are kept, the split one is not."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.explode(split_parts(F.col(col), sep)).alias(name))


def select_where(df: DataFrame, cols: Sequence[str], pred: Column) -> DataFrame:
    return df.where(pred).select(*cols)


def select_where_sql(df: DataFrame, cols: Sequence[str], pred: str) -> DataFrame:
    """The same as a SQL statement over the frame."""
    return df.sparkSession.sql(f"SELECT {', '.join(cols)} FROM {{src}} WHERE {pred}", src=df)


def with_schema(df: DataFrame, columns: dict[str, Column | str]) -> DataFrame:
    """Rename, reorder and compute columns: new name -> column."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def page_requests(df: DataFrame, method: str = "method", url: str = "url") -> DataFrame:
    """GET requests that are not for a static resource."""
    return df.where(is_page_request(F.col(method), F.col(url)))


def tag_rows(df: DataFrame, rules: dict[str, Column], default: str | None = None, tag: str = "tag") -> DataFrame:
    """Label each row with the first rule it meets; rows that meet none get `default` (null drops them on routing)."""
    label = F.lit(default).cast("string")
    for name, pred in reversed(rules.items()):
        label = F.when(pred, F.lit(name)).otherwise(label)
    return df.withColumn(tag, label)


def pick(tagged: DataFrame, *tags: str, tag: str = "tag") -> DataFrame:
    return tagged.where(F.col(tag).isin(*tags))


def route(
    df: DataFrame, rules: dict[str, Column], default: str | None = None, tag: str = "tag"
) -> dict[str, DataFrame]:
    """One filtered frame per tag."""
    tagged = tag_rows(df, rules, default, tag)
    names = list(rules) + ([default] if default else [])
    return {name: pick(tagged, name, tag=tag).drop(tag) for name in names}


def distribute(df: DataFrame, how: str, n: int, expr: Column | None = None) -> DataFrame:
    """Place rows over `n` partitions: forward, random, round_robin, rescale, single, or by a partition-number `expr`.

    `broadcast` sends a table of at most `n` rows to every task of a later join; a larger one is left as it is.
    `single` puts everything on one partition and is for outputs known to be small.
    """
    if how == "forward":
        return df
    if how == "broadcast":
        return F.broadcast(df) if df.limit(n + 1).count() <= n else df
    if how == "random":
        return df.repartition(n, F.rand(seed=17))
    if how == "round_robin":
        return df.repartition(n)
    if how == "rescale":
        return df.coalesce(n)
    if how == "single":
        return df.coalesce(1)
    if how == "custom":
        return df.repartitionById(n, expr.cast("int"))
    raise ValueError(f"unknown distribution: {how}")


def map_partitions(
    df: DataFrame,
    open_: Callable[[], object],
    fn: Callable[[object, pd.DataFrame], pd.DataFrame],
    close: Callable[[object], None],
    schema: str,
) -> DataFrame:
    """Map Arrow batches with a resource opened and closed once per partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_()
        try:
            for batch in batches:
                yield fn(resource, batch)
        finally:
            close(resource)

    return df.mapInPandas(run, schema)
