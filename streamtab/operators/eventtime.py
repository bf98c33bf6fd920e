"""Event time, watermarks and late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtab.functions.times import epoch_us, from_us, micros
from streamtab.operators.scan import run_max, run_over


def with_event_time(df: DataFrame, ts: str, delay: str = "0 seconds", expr: Column | None = None) -> DataFrame:
    """Declare `ts` (or `expr`, stored under that name) as event time with a bound on disorder."""
    timed = df.withColumn(ts, (F.col(ts) if expr is None else expr).cast("timestamp"))
    return timed.withWatermark(ts, delay) if df.isStreaming else timed


def with_processing_time(df: DataFrame, name: str = "pt") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def with_watermark_at(
    df: DataFrame, order: Sequence[str], ts: str, delay: str, marker: Column | None = None, name: str = "watermark"
) -> DataFrame:
    """The watermark each row meets on arrival: the largest `ts` up to it in arrival order, less `delay`.

    With `marker`, only rows that meet it move the watermark. The prefix maximum is distributed (see `scan`).
    """
    seen = epoch_us(ts) if marker is None else F.when(marker, epoch_us(ts))
    scanned = run_over(df, [], order, {"_high": run_max(seen)})
    mark = from_us(F.col("_high") - micros(delay)).cast(df.schema[ts].dataType)
    return scanned.withColumn(name, mark).drop("_high")


def late_flags(
    df: DataFrame, order: Sequence[str], ts: str, delay: str, marker: Column | None = None
) -> DataFrame:
    """Mark rows whose own time is behind the watermark they meet."""
    timed = with_watermark_at(df, order, ts, delay, marker)
    return timed.withColumn("is_late", F.coalesce(F.col(ts) < F.col("watermark"), F.lit(False)))


def split_late(
    df: DataFrame, ts: str, arrival: Sequence[str], size: str, delay: str, lateness: str = "0 seconds"
) -> DataFrame:
    """Tag rows `late` when their window had closed on arrival: window end + lateness <= watermark."""
    width = micros(size)
    end = (F.floor(epoch_us(ts) / F.lit(width)) + 1) * width
    timed = with_watermark_at(df, arrival, ts, delay)
    closed = end + micros(lateness) <= epoch_us("watermark")
    return timed.withColumn("tag", F.when(closed, "late").otherwise("on_time")).drop("watermark")
