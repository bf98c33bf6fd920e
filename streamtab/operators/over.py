"""Rolling per-key aggregates, OVER windows and top-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamtab.functions.times import epoch_us
from streamtab.operators.scan import frame, run_count, run_first, run_max, run_over, run_sum


# Pieces of a part when its cut is too large to be made before the shuffle.
PIECES = 32


def _descending(df: DataFrame, col: str) -> Column:
    return -(epoch_us(col) if df.schema[col].dataType.typeName().startswith("timestamp") else F.col(col))


def rolling(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], kind: str, col: str | None = None, seq: str = "seq"
) -> DataFrame:
    """One output row per input row. `seq` numbers a key's rows.

    sum, max: the aggregate so far, the other fields as in the key's first row. max_by: the whole row that holds the
    maximum so far (the earlier on a tie). reduce: the current row with the maximum so far. count: rows so far.
    """
    numbered = {seq: run_count()}
    if kind == "count":
        return run_over(df, keys, order, numbered)
    if kind == "reduce":
        done = run_over(df, keys, order, {**numbered, "_v": run_max(F.col(col))})
        return done.select(*[F.col("_v").alias(c) if c == col else F.col(c) for c in df.columns], seq)
    if kind == "max_by":
        best = F.struct(
            F.col(col).alias("_v"),
            *[_descending(df, c).alias(f"_o{i}") for i, c in enumerate(order)],
            F.struct(*df.columns).alias("_row"),
        )
        done = run_over(df, keys, order, {**numbered, "_best": run_max(best)})
        return done.select(*[F.col("_best._row")[c].alias(c) for c in df.columns], seq)
    total = {"sum": run_sum, "max": run_max}[kind](F.col(col))
    done = run_over(
        df, keys, order, {**numbered, "_v": total, "_first": run_first(F.struct(*df.columns))}
    )
    return done.select(*[F.col("_v").alias(c) if c == col else F.col("_first")[c].alias(c) for c in df.columns], seq)


def over_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], preceding: int, aggs: dict[str, Column]
) -> DataFrame:
    """Aggregates over the `preceding` rows before the current one and the current one."""
    return run_over(df, keys, order, {n: frame(c, preceding) for n, c in aggs.items()})


def top_n(df: DataFrame, part: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First `n` rows of each part with their rank. The filter on the rank lets every task cut to `n` rows per part
    before the shuffle, so a hot part costs n rows per task. Where `n` is too large for that, a part is first cut in
    salted pieces, so a hot part is spread over PIECES tasks and costs n rows of each."""
    w = Window.partitionBy(*part).orderBy(*order)
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n >= limit and part:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(PIECES))
        pieces = Window.partitionBy(*part, "_piece").orderBy(*order)
        df = df.withColumn("_piece", salt).withColumn("_nth", F.row_number().over(pieces)).where(F.col("_nth") <= n).drop("_piece", "_nth")
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def top_k_values(df: DataFrame, key: str, col: str, k: int = 2, tie: str | None = None) -> DataFrame:
    """The `k` largest positive values per key with rank 1..k; repeats of a value take separate ranks."""
    order = [F.col(col).desc(), *([F.col(tie)] if tie else [])]
    return top_n(df.where(F.col(col) > 0), [key], order, k).select(key, col, "rank")
