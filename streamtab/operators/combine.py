"""Joins of two event tables and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtab.functions.times import epoch_us, micros
from streamtab.operators.scan import run_max, run_min, run_over


def union_all(*frames: DataFrame) -> DataFrame:
    """Merge same-typed frames, keeping duplicates."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def co_map(a: DataFrame, fa: dict[str, Column], b: DataFrame, fb: dict[str, Column]) -> DataFrame:
    """Two frames of different type mapped to one."""
    return a.select(*[c.alias(n) for n, c in fa.items()]).unionByName(b.select(*[c.alias(n) for n, c in fb.items()]))


def lateral(df: DataFrame, rows: Column) -> DataFrame:
    """Each row crossed with the structs of its own array column."""
    return df.select("*", F.inline(rows))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    lower: str,
    upper: str,
    how: str = "inner",
) -> DataFrame:
    """Pairs with equal keys and `right_ts` in `[left_ts + lower, left_ts + upper]`, both ends included.

    Streams join on the condition itself (both sides need a watermark). Batch tables join on (key, time bucket): a
    bucket is as wide as the interval, right rows go to the one or two buckets whose left rows can match, so a
    key's rows are spread over time and every pair meets once. What stays hot is split by the adaptive skew join.
    `how` other than inner is for streams; `match_two` is the batch form.
    """
    lo, hi = micros(lower), micros(upper)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    if left.isStreaming or right.isStreaming:
        cond = F.expr(
            f"{right_ts} >= {left_ts} + INTERVAL '{lo}' MICROSECOND AND "
            f"{right_ts} <= {left_ts} + INTERVAL '{hi}' MICROSECOND"
        )
        for k in keys:
            cond = cond & (left[k] == r[f"_r_{k}"])
        joined = left.join(r, cond, how)
        merged = [F.coalesce(left[k], r[f"_r_{k}"]).alias(k) for k in keys]
        return joined.select(*merged, *[c for c in joined.columns if c not in keys and c not in r.columns[: len(keys)]])
    if how != "inner":
        raise ValueError("batch interval joins are inner; use match_two")

    width = F.lit(max(hi - lo, 1))
    lt, rt = epoch_us(left_ts), epoch_us(right_ts)
    lb = left.withColumn("_lt", lt).withColumn("_b", F.floor(F.col("_lt") / width))
    rb = r.withColumn("_rt", rt).withColumn(
        "_rb", F.explode(F.sequence(F.floor((F.col("_rt") - hi) / width), F.floor((F.col("_rt") - lo) / width)))
    )
    cond = (F.col("_b") == F.col("_rb")) & (F.col("_rt") - F.col("_lt")).between(lo, hi)
    for k in keys:
        cond = cond & (lb[k] == rb[f"_r_{k}"])
    return lb.join(rb, cond).drop("_lt", "_rt", "_b", "_rb", *[f"_r_{k}" for k in keys])


def unmatched(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, lower: str, upper: str
) -> DataFrame:
    """Rows of either side with no partner in the interval: keys, `side`, `row_left`, `row_right`.

    A row has a partner exactly when its nearest neighbour of the other side, before or after, is in range. So one
    ordered pass decides it without forming pairs, whatever the size of a key.
    """
    lo, hi = micros(lower), micros(upper)
    mid = (lo + hi) // 2 if lo > 0 or hi < 0 else 0
    lo, hi = lo - mid, hi - mid
    ltype, rtype = left.schema.simpleString(), right.schema.simpleString()
    a = left.select(
        *keys,
        F.lit(0).alias("side"),
        epoch_us(left_ts).alias("_t"),
        F.struct(*left.columns).alias("row_left"),
        F.lit(None).cast(rtype).alias("row_right"),
    )
    b = right.select(
        *keys,
        F.lit(1).alias("side"),
        (epoch_us(right_ts) - mid).alias("_t"),
        F.lit(None).cast(ltype).alias("row_left"),
        F.struct(*right.columns).alias("row_right"),
    )
    lt = F.when(F.col("side") == 0, F.col("_t"))
    rt = F.when(F.col("side") == 1, F.col("_t"))
    seen = run_over(
        a.unionByName(b),
        keys,
        ["_t", "side"],
        {
            "_lb": run_max(lt),
            "_la": run_min(lt, backward=True),
            "_rb": run_max(rt),
            "_ra": run_min(rt, backward=True),
        },
    )
    t = F.col("_t")
    left_hit = F.coalesce(F.col("_rb") >= t + lo, F.lit(False)) | F.coalesce(F.col("_ra") <= t + hi, F.lit(False))
    right_hit = F.coalesce(F.col("_lb") >= t - hi, F.lit(False)) | F.coalesce(F.col("_la") <= t - lo, F.lit(False))
    return seen.where(F.when(F.col("side") == 0, ~left_hit).otherwise(~right_hit)).select(
        *keys, "side", "row_left", "row_right"
    )


def match_two(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    left_wait: str,
    right_wait: str,
) -> DataFrame:
    """Every pair in range as 'matched', and what found no partner as 'left_only' or 'right_only'.

    A left row waits `left_wait` for its right row, a right row `right_wait` for its left row. A row with a null key
    equals no other and stays alone.
    """
    lower, upper = f"-{right_wait}", left_wait
    lcols = [c for c in left.columns if c not in keys]
    rcols = [c for c in right.columns if c not in keys]
    if left.isStreaming or right.isStreaming:
        both = interval_join(left, right, keys, left_ts, right_ts, lower, upper, "full_outer")
        status = F.when(F.col(right_ts).isNull(), "left_only").when(F.col(left_ts).isNull(), "right_only")
        return both.select(*keys, *lcols, *rcols, status.otherwise("matched").alias("status"))
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    lost = left.where(~whole).select(
        *keys, *lcols, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in rcols], F.lit("left_only").alias("status")
    )
    lost = lost.unionByName(
        right.where(~whole).select(
            *keys, *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in lcols], *rcols, F.lit("right_only").alias("status")
        )
    )
    left, right = left.where(whole), right.where(whole)
    pairs = interval_join(left, right, keys, left_ts, right_ts, lower, upper)
    pairs = pairs.select(*keys, *lcols, *rcols, F.lit("matched").alias("status"))
    alone = unmatched(left, right, keys, left_ts, right_ts, lower, upper).select(
        *keys,
        *[F.col("row_left")[c].alias(c) for c in lcols],
        *[F.col("row_right")[c].alias(c) for c in rcols],
        F.when(F.col("side") == 0, "left_only").otherwise("right_only").alias("status"),
    )
    return pairs.unionByName(alone).unionByName(lost)
