"""The ready-made analytic jobs, composed from the operators. Column names are arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtab.functions.text import is_page_request
from streamtab.operators.aggregate import salted_total
from streamtab.operators.over import top_n
from streamtab.operators.pattern import cap_per_day, first_of_day, fix_new_flag
from streamtab.operators.scan import running_count
from streamtab.operators.windows import slide

COUNT = {"cnt": ("count", "*")}


def hot_items(
    df: DataFrame, ts: str = "ts", item: str = "item_id", n: int = 5, size: str = "1 hour", step: str = "5 minutes"
) -> DataFrame:
    """Top `n` items of every sliding window; equal counts rank by item."""
    counts = slide(df, ts, size, step, [item], COUNT)
    return top_n(counts, ["window_end"], [F.col("cnt").desc(), F.col(item)], n)


def hot_items_sql(df: DataFrame, n: int = 5, size: str = "1 hour", step: str = "5 minutes") -> DataFrame:
    """The same as one SQL statement over a frame with `item_id` and `ts`."""
    return df.sparkSession.sql(
        f"""
        SELECT window_end, item_id, cnt, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rank FROM (
                SELECT item_id, w.end AS window_end, count(*) AS cnt
                FROM (SELECT item_id, window(ts, '{size}', '{step}') AS w FROM {{src}})
                GROUP BY item_id, w))
        WHERE rank <= {n}
        """,
        src=df,
    )


def hot_pages(
    df: DataFrame, ts: str = "ts", n: int = 3, size: str = "10 minutes", step: str = "5 seconds"
) -> DataFrame:
    """Top `n` pages of every sliding window, GET requests of pages only."""
    views = df.where(is_page_request(F.col("method"), F.col("url")))
    counts = slide(views, ts, size, step, ["url"], COUNT)
    return top_n(counts, ["window_end"], [F.col("cnt").desc(), F.col("url")], n)


def page_views(df: DataFrame, ts: str, row_id: str, size: str = "1 hour") -> DataFrame:
    return salted_total(df, ts, size, row_id, "pv", 10)


def channel_counts(
    df: DataFrame, ts: str, channel: str, behavior: str, excluded: str, size: str = "1 hour", step: str = "5 seconds"
) -> DataFrame:
    """Count per channel and behaviour over long sliding windows, one behaviour left out."""
    return slide(df.where(F.col(behavior) != excluded), ts, size, step, [channel, behavior], COUNT)


def channel_total(
    df: DataFrame, ts: str, behavior: str, excluded: str, size: str = "1 hour", step: str = "5 seconds"
) -> DataFrame:
    """The same over all rows, labelled total."""
    counts = slide(df.where(F.col(behavior) != excluded), ts, size, step, [], COUNT)
    return counts.select(F.lit("total").alias("channel"), F.lit("total").alias("behavior"), "window_end", "cnt")


def province_clicks(
    df: DataFrame, keys: list[str], order: list[str], province: str, limit: int = 100, zone: str = "UTC"
) -> tuple[DataFrame, DataFrame]:
    """(clicks per province and sliding window after the daily cap, warnings for who went over it)."""
    passed, warned = cap_per_day(df, keys, order, limit, zone)
    return slide(passed, order[0], "1 hour", "5 minutes", [province], COUNT), warned


def first_visits(df: DataFrame, key: str, order: list[str], flag: str, is_page: Column, zone: str = "UTC") -> DataFrame:
    """Fix the new-visitor flag, keep page rows that open a visit, one per visitor and day."""
    fixed = fix_new_flag(df, [key], order, flag)
    return first_of_day(fixed.where(is_page), [key], order, zone)


def daily_uv(df: DataFrame, key: str, order: list[str], flag: str, is_page: Column, zone: str = "UTC") -> DataFrame:
    """Running visitor total: label, the visitor just counted, and the count so far."""
    firsts = first_visits(df, key, order, flag, is_page, zone)
    return running_count(firsts, order, "uv").select(F.lit("uv").alias("label"), key, *order, "uv")
