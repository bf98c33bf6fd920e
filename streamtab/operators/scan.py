"""Ordered per-key computation that survives a key of any size.

`run_over` is the one place where rows of a key are put in order. Keys of ordinary size go through a normal
Spark window: one shuffle on the key. A key with more rows than `hot_rows` is never put on one task: its rows are
range-partitioned by the full order, numbered, cut into chunks of equal row count, computed chunk by chunk, and joined
with the carry of the chunks before (or after) them. With no key at all the whole table takes the chunked way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from streamtab.session import ready_checkpoints

HOT_ROWS_KEY = "streamtab.hotKeyRows"
CHUNK_ROWS_KEY = "streamtab.chunkRows"
HOT_ROWS = 5_000_000
CHUNK_ROWS = 1_000_000
# A key is cut into at most this many chunks, so the scan over its chunk totals stays small.
MAX_CHUNKS = 100_000
# Largest side table, by its size as text, that is broadcast; beyond it the join is left to Spark.
BROADCAST_BYTES = 32_000_000


@dataclass(frozen=True)
class Running:
    """Aggregate from the key's first row to the current one; `backward` runs from the last row instead."""

    kind: str
    expr: Column
    backward: bool = False


@dataclass(frozen=True)
class Near:
    """Expression over a bounded neighbourhood: at most `back` rows before and `ahead` rows after."""

    build: Callable[[WindowSpec], Column]
    back: int = 0
    ahead: int = 0


def run_sum(expr: Column, backward: bool = False) -> Running:
    return Running("sum", expr, backward)


def run_max(expr: Column, backward: bool = False) -> Running:
    return Running("max", expr, backward)


def run_min(expr: Column, backward: bool = False) -> Running:
    return Running("min", expr, backward)


def run_first(expr: Column, backward: bool = False) -> Running:
    return Running("first", expr, backward)


def run_count() -> Running:
    return Running("sum", F.lit(1).cast("bigint"))


def lag(col: str, n: int = 1) -> Near:
    return Near(lambda w: F.lag(col, n).over(w), back=n)


def lead(col: str, n: int = 1) -> Near:
    return Near(lambda w: F.lead(col, n).over(w), ahead=n)


def frame(agg: Column, preceding: int) -> Near:
    """`agg` over the `preceding` rows before the current one and the current one."""
    return Near(lambda w: agg.over(w.rowsBetween(-preceding, 0)), back=preceding)


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, hint: bool = False) -> DataFrame:
    """Null-safe equi-join that keeps the left key columns only."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    side = F.broadcast(renamed) if hint else renamed
    joined = left.join(side, _same(left, renamed, [(k, f"_r_{k}") for k in keys]), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])


@dataclass(frozen=True)
class Hot:
    """Outcome of a check for oversized keys: a table of them, or None, and whether it may be broadcast."""

    keys: DataFrame | None
    small: bool = False


def is_small(df: DataFrame) -> bool:
    """Whether a table that is already computed is small enough to broadcast, measured over all its rows."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0]
    return (size or 0) <= BROADCAST_BYTES


def hot_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(HOT_ROWS_KEY, str(HOT_ROWS)))


def find_hot(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> Hot:
    """Keys with more than `hot_rows` rows. Reads the key columns only; counts are combined map-side."""
    limit = hot_rows or hot_limit(df.sparkSession)
    hot = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).drop("_n")
    if hot.isEmpty():
        return Hot(None)
    ready_checkpoints(df.sparkSession)
    kept = hot.checkpoint()
    return Hot(kept, is_small(kept))


def _numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> tuple[DataFrame, int]:
    """`number_rows`, with the row count of the largest key."""
    ready_checkpoints(df.sparkSession)
    cols = [*keys, *order]
    kept = df.repartitionByRange(*cols).sortWithinPartitions(*cols).checkpoint()
    placed = kept.withColumn("_mid", F.monotonically_increasing_id())
    placed = placed.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_idx", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    )
    pieces = placed.groupBy(*keys, "_pid").agg(F.min("_idx").alias("_start"), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    prior = F.coalesce(F.sum("_n").over(before), F.lit(0))
    shift = pieces.select(
        *keys, "_pid", (prior - F.col("_start") + 1).alias("_shift"), (prior + F.col("_n")).alias("_upto")
    ).checkpoint()
    # At most one row per partition plus one per key; measured before it is broadcast.
    largest = shift.agg(F.max("_upto")).first()[0]
    numbered = _join_on(placed, shift.drop("_upto"), [*keys, "_pid"], "inner", hint=is_small(shift))
    numbered = numbered.withColumn(name, F.col("_idx") + F.col("_shift")).drop("_mid", "_pid", "_idx", "_shift")
    return numbered, largest or 0


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn") -> DataFrame:
    """Exact 1-based position of each row within its key, with no key and no table on one task.

    The sorted range partitions are checkpointed once, so a lost executor re-reads the same cut. The position
    inside a partition comes from the row id; what is joined back is one row per (partition, key) piece.
    """
    return _numbered(df, keys, order, name)[0]


def _agg(kind: str, expr: Column) -> Column:
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](expr)


def _local(run: Running, w: WindowSpec, own: Column | None) -> Column:
    span = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if run.kind == "first":
        boxed = F.struct(run.expr.alias("v"))
        return F.first(boxed if own is None else F.when(own, boxed), ignorenulls=True).over(span)
    return _agg(run.kind, run.expr if own is None else F.when(own, run.expr)).over(span)


def _merge(kind: str, carry: Column, local: Column) -> Column:
    if kind == "sum":
        return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(carry + local)
    if kind == "max":
        return F.greatest(carry, local)
    if kind == "min":
        return F.least(carry, local)
    return F.coalesce(carry, local)


def _plain(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: dict[str, Running | Near]) -> DataFrame:
    up = Window.partitionBy(*keys).orderBy(*order)
    down = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    made = []
    for name, spec in cols.items():
        if isinstance(spec, Near):
            made.append(spec.build(up).alias(name))
        else:
            out = _local(spec, down if spec.backward else up, None)
            made.append((out["v"] if spec.kind == "first" else out).alias(name))
    return df.select("*", *made)


def _chunked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: dict[str, Running | Near], chunk_rows: int
) -> DataFrame:
    names = df.columns
    chunk_rows = max([chunk_rows] + [max(c.back, c.ahead) for c in cols.values() if isinstance(c, Near)])
    back = max([c.back for c in cols.values() if isinstance(c, Near)], default=0)
    ahead = max([c.ahead for c in cols.values() if isinstance(c, Near)], default=0)
    runs = {n: c for n, c in cols.items() if isinstance(c, Running)}

    numbered, largest = _numbered(df, keys, order, "_rn")
    chunk_rows = max(chunk_rows, -(-largest // MAX_CHUNKS))
    at = (F.col("_rn") - 1) % F.lit(chunk_rows)
    home = ((F.col("_rn") - 1) / F.lit(chunk_rows)).cast("bigint")
    # The key as one struct: equal also where a field is null, so windows and the carry join share one partitioning.
    cut = numbered.withColumn("_home", home).withColumn("_kkey", F.struct(*keys) if keys else F.lit(0))

    if back or ahead:
        # Edge rows are also sent to the neighbouring chunk, where they only serve as context.
        copies = F.array_compact(
            F.array(
                F.col("_home"),
                F.when(at >= chunk_rows - back, F.col("_home") + 1) if back else F.lit(None).cast("bigint"),
                F.when(at < ahead, F.col("_home") - 1) if ahead else F.lit(None).cast("bigint"),
            )
        )
        spread = cut.withColumn("_chunk", F.explode(copies))
        own = F.col("_chunk") == F.col("_home")
    else:
        spread = cut.withColumn("_chunk", F.col("_home"))
        own = None

    up = Window.partitionBy("_kkey", "_chunk").orderBy("_rn")
    down = Window.partitionBy("_kkey", "_chunk").orderBy(F.col("_rn").desc())
    made = [
        (c.build(up) if isinstance(c, Near) else _local(c, down if c.backward else up, own)).alias(f"_c_{n}")
        for n, c in cols.items()
    ]
    done = spread.select("*", *made)
    if own is not None:
        done = done.where(own)

    if runs:
        totals = []
        for n, c in runs.items():
            if c.kind == "first":
                pick = F.max if c.backward else F.min
                totals.append(pick(F.struct("_rn", F.struct(c.expr.alias("v")).alias("s")))["s"].alias(f"_t_{n}"))
            else:
                totals.append(_agg(c.kind, c.expr).alias(f"_t_{n}"))
        per_chunk = cut.groupBy("_kkey", F.col("_home").alias("_chunk")).agg(*totals)
        fwd = Window.partitionBy("_kkey").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        bwd = Window.partitionBy("_kkey").orderBy(F.col("_chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
        carries = []
        for n, c in runs.items():
            w = bwd if c.backward else fwd
            total = F.col(f"_t_{n}")
            carry = F.first(total, ignorenulls=True) if c.kind == "first" else _agg(c.kind, total)
            carries.append(carry.over(w).alias(f"_p_{n}"))
        done = done.join(per_chunk.select("_kkey", "_chunk", *carries), ["_kkey", "_chunk"])

    out = []
    for n, c in cols.items():
        value = F.col(f"_c_{n}")
        if isinstance(c, Running):
            value = _merge(c.kind, F.col(f"_p_{n}"), value)
            value = value["v"] if c.kind == "first" else value
        out.append(value.alias(n))
    return done.select(*names, *out)


def run_over(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: dict[str, Running | Near],
    hot_rows: int | None = None,
    chunk_rows: int | None = None,
    hot: Hot | None = None,
) -> DataFrame:
    """Add ordered per-key columns. `order` must be a total order within a key for repeatable results.

    `hot` is an earlier `find_hot` for the same keys, to spare the check.
    """
    conf = df.sparkSession.conf
    chunk_rows = int(chunk_rows or conf.get(CHUNK_ROWS_KEY, str(CHUNK_ROWS)))
    if not keys:
        return _chunked(df, [], order, cols, chunk_rows)
    hot = hot or find_hot(df, keys, hot_rows)
    if hot.keys is None:
        return _plain(df, keys, order, cols)
    # Hot keys number at most rows / hot_rows: broadcast, so no row is shuffled on the skewed key to learn that it is hot.
    calm = _plain(_join_on(df, hot.keys, keys, "left_anti", hint=hot.small), keys, order, cols)
    busy = _chunked(_join_on(df, hot.keys, keys, "left_semi", hint=hot.small), keys, order, cols, chunk_rows)
    return calm.unionByName(busy)


def running_count(df: DataFrame, order: Sequence[str], name: str = "n") -> DataFrame:
    """Position of every row in the whole table."""
    return number_rows(df, [], order, name)
