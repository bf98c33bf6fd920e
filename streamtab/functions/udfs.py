"""User-defined functions: SQL registration of the scalar hash, the table function and the aggregates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from streamtab.functions.text import split_parts


# Rows a task keeps while folding before it passes them on.
FOLD_ROWS = 100_000


def word_lengths(col: Column, sep: str = "_") -> Column:
    """Array of (word, length) structs, the column form of the table function."""
    return F.transform(
        split_parts(col, sep), lambda w: F.struct(w.alias("word"), F.length(w).cast("bigint").alias("length"))
    )


@F.udtf(returnType=StructType().add("word", StringType()).add("length", LongType()))
class SplitWords:
    """Table function: (word, length) of each part of a text."""

    def eval(self, text: str, sep: str):
        if text is None:
            return
        parts = text.split(sep)
        while len(parts) > 1 and parts[-1] == "":
            parts.pop()
        for part in parts:
            yield part, len(part)


@F.pandas_udf(DoubleType())
def avg_temp(values: pd.Series) -> float:
    """Grouped aggregate over a bounded group; `avg` is the form for groups of any size. Null without values."""
    return float(values.mean()) if values.count() else None


def _plain(frame: pd.DataFrame, key: str) -> pd.DataFrame:
    """Missing keys as None: grouping turns them into NaN, which is no text."""
    missing = frame[key].isna()
    return frame.assign(**{key: frame[key].astype(object).where(~missing, None)}) if missing.any() else frame


def custom_aggregate(
    df: DataFrame,
    key: str,
    add: Callable[[pd.DataFrame], pd.DataFrame],
    merge: dict[str, Callable[[str], Column]],
    schema: str,
    result: Column,
    name: str,
) -> DataFrame:
    """User aggregate with an accumulator.

    `add` folds an Arrow batch to one accumulator row per key (`schema`), `merge` names the Spark aggregate that
    combines each field, `result` turns the merged fields into the value. Only accumulators are shuffled.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _plain(add(batch), key)

    merged = df.mapInPandas(fold, schema).groupBy(key).agg(*[f(c).alias(c) for c, f in merge.items()])
    return merged.select(key, result.alias(name))


def average(df: DataFrame, key: str, col: str, name: str) -> DataFrame:
    """Mean by a (sum, count) accumulator; null for a group without values. pandas does not tell NaN from null: both count as missing."""
    kind = df.schema[key].dataType.simpleString()

    def add(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.groupby(key, dropna=False)[col].agg(total="sum", n="count").reset_index()

    return custom_aggregate(
        df.select(key, F.col(col).cast("double").alias(col)),
        key,
        add,
        {"total": F.sum, "n": F.sum},
        f"{key} {kind}, total double, n bigint",
        F.try_divide("total", "n"),
        name,
    )


def register(spark: SparkSession) -> None:
    """Make the functions callable from SQL."""
    spark.udtf.register("split_words", SplitWords)
    spark.udf.register("avg_temp", avg_temp)
    # A SQL function keeps the hash inside generated code.
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION hash_code(s STRING, factor BIGINT) RETURNS BIGINT RETURN
        factor * (SELECT IF(h >= 2147483648, h - 4294967296, h) FROM (SELECT aggregate(
            regexp_extract_all(hex(encode(s, 'UTF-16BE')), '(....)', 1), 0L,
            (a, u) -> (a * 31 + CAST(conv(u, 16, 10) AS BIGINT)) & 4294967295L) AS h))
        """
    )


def top2(df: DataFrame, key: str, col: str) -> DataFrame:
    """Table aggregate: the two largest positive values per key with their rank.

    Each task first folds its rows to at most two values per key; the grouped function then sees two rows per task
    and key, never a whole group.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, {col} double, rank int"

    def fold(batches):
        best = None
        for batch in batches:
            rows = batch if best is None else pd.concat([best, batch])
            best = rows[rows[col] > 0].sort_values(col, ascending=False).groupby(key, dropna=False).head(2)
            if len(best) > FOLD_ROWS:
                yield _plain(best, key)
                best = None
        if best is not None:
            yield _plain(best, key)

    def emit(pdf: pd.DataFrame) -> pd.DataFrame:
        best = pdf.sort_values(col, ascending=False).head(2)
        return _plain(best.assign(rank=range(1, len(best) + 1)), key)

    part = df.select(key, F.col(col).cast("double").alias(col)).mapInPandas(fold, f"{key} {kind}, {col} double")
    return part.groupBy(key).applyInPandas(emit, schema)
