"""Grouped counts and sums, including the two-phase forms for skewed keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtab.functions.text import split_parts


def word_count(df: DataFrame, col: str) -> DataFrame:
    """Count of each part of a space-split line; inner empty parts count as words."""
    words = df.select(F.explode(split_parts(F.col(col), " ")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("cnt"))


def group_agg(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def preagg_count(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    """Keyed count. Spark combines on the map side, so each task sends one row per key over the network."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def _window(df: DataFrame, ts: str, size: str) -> Column:
    return F.window(F.col(ts), size)


def salted_window_count(
    df: DataFrame, ts: str, keys: Sequence[str], size: str, row_id: str, salts: int = 5
) -> DataFrame:
    """Count per (key, window) in two phases; the salt comes from the row id, so a retry repeats it."""
    salt = F.pmod(F.xxhash64(row_id), F.lit(salts))
    first = df.groupBy(_window(df, ts, size).alias("w"), *keys, salt.alias("_salt")).agg(F.count("*").alias("_n"))
    second = first.groupBy("w", *keys).agg(F.sum("_n").alias("cnt"))
    return second.select(*keys, F.col("w.end").alias("window_end"), "cnt")


def salted_total(df: DataFrame, ts: str, size: str, row_id: str, label: str = "pv", salts: int = 10) -> DataFrame:
    """Total per window over all rows, in two phases: (label, window end, total)."""
    counts = salted_window_count(df, ts, [], size, row_id, salts)
    return counts.select(F.lit(label).alias("label"), "window_end", "cnt")


def split_count_distinct(
    df: DataFrame, keys: Sequence[str], col: str, buckets: int = 1024, name: str = "cnt"
) -> DataFrame:
    """Exact distinct count in two phases: distinct per hash bucket of the value, then the sum of the buckets."""
    bucket = F.pmod(F.xxhash64(col), F.lit(buckets)).alias("_bucket")
    part = df.groupBy(*keys, bucket).agg(F.count_distinct(col).alias("_n"))
    return part.groupBy(*keys).agg(F.sum("_n").alias(name))


def distinct_counts(df: DataFrame, keys: Sequence[str], counts: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Distinct counts gated by a condition, in CASE form: name -> (column, SQL condition or None)."""
    aggs = {
        n: F.count_distinct(F.expr(f"CASE WHEN {cond} THEN {c} END") if cond else F.col(c))
        for n, (c, cond) in counts.items()
    }
    return group_agg(df, keys, aggs)


def distinct_counts_filter(
    df: DataFrame, keys: Sequence[str], counts: dict[str, tuple[str, str | None]]
) -> DataFrame:
    """The same in FILTER form."""
    exprs = [
        f"count(DISTINCT {c})" + (f" FILTER (WHERE {cond})" if cond else "") + f" AS {n}"
        for n, (c, cond) in counts.items()
    ]
    by = ", ".join(keys)
    return df.sparkSession.sql(f"SELECT {by}, {', '.join(exprs)} FROM {{src}} GROUP BY {by}", src=df)


def day_key_count(df: DataFrame, ts: str, keys: Sequence[str]) -> DataFrame:
    """Count per day (yyyyMMdd) and key."""
    return df.groupBy(F.date_format(ts, "yyyyMMdd").alias("day"), *keys).agg(F.count("*").alias("cnt"))
