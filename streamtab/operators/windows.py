"""Time, session and count windows. Windows are epoch-aligned and half-open; `window_end` is exclusive."""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamtab.functions.text import bitmap_slot
from streamtab.functions.times import epoch_us, from_us, micros
from streamtab.operators.scan import find_hot, frame, lag, run_count, run_over, run_sum

# Beyond this many windows per row, rows are first folded into panes.
EXPAND_LIMIT = 4


def tumble(df: DataFrame, ts: str, size: str, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Aggregates per key and tumbling window. On a watermarked stream each closed window is emitted once in append
    mode, and re-emitted for every change in update mode."""
    out = df.groupBy(F.window(F.col(ts), size).alias("_w"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(
        *keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *aggs.keys()
    )


def extreme_row(df: DataFrame, value: str, tie: Sequence[str], largest: bool = False) -> Column:
    """The whole row with the smallest (or largest) `value`; the first in `tie` order wins a tie."""
    rank = [F.col(value), *[F.col(c) for c in tie]]
    if largest:
        rank = [F.col(value), *[-(epoch_us(c) if c in _times(df) else F.col(c)) for c in tie]]
    pick = F.max_by if largest else F.min_by
    return pick(F.struct(*df.columns), F.struct(*rank))


def _times(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName().startswith("timestamp")]


def slide(
    df: DataFrame,
    ts: str,
    size: str,
    step: str,
    keys: Sequence[str],
    aggs: dict[str, tuple[str, str]],
    strategy: str = "auto",
) -> DataFrame:
    """Sliding windows: keys, window_end and mergeable aggregates, name -> (count|sum|min|max|avg, column or '*').

    `expand` lets Spark copy each row into size/step windows; `panes` folds rows into non-overlapping panes first and
    combines panes, so the copies are of panes and not of rows; on a stream each closed window is emitted once, append mode. `auto` takes
    panes for long windows; both forms return the same types.
    """
    if strategy == "auto":
        strategy = "expand" if micros(size) // micros(step) <= EXPAND_LIMIT else "panes"
    if strategy == "expand":
        out = df.groupBy(F.window(F.col(ts), size, step).alias("_w"), *keys).agg(
            *[_plain_agg(kind, col).alias(n) for n, (kind, col) in aggs.items()]
        )
        return out.select(*keys, F.col("_w.end").alias("window_end"), *aggs.keys())
    if df.isStreaming:
        from streamtab.streaming.panes import slide_stream

        return slide_stream(df, ts, size, step, keys, aggs)
    return _slide_panes(df, ts, micros(size), micros(step), keys, aggs)


def _plain_agg(kind: str, col: str) -> Column:
    if kind == "count":
        return F.count(col)
    return {"sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}[kind](col)


def _pane_parts(aggs: dict[str, tuple[str, str]]) -> dict[str, Column]:
    """What a pane keeps for each aggregate; every part folds by sum, min or max, named by its suffix."""
    parts: dict[str, Column] = {}
    for n, (kind, col) in aggs.items():
        if kind in ("count", "avg"):
            parts[f"_{n}_count"] = F.count(col)
        if kind in ("sum", "avg"):
            parts[f"_{n}_sum"] = F.sum(col)
        if kind in ("min", "max"):
            parts[f"_{n}_{kind}"] = _plain_agg(kind, col)
    parts["_rows"] = F.count("*")
    return parts


def _part_fold(name: str):
    return F.min if name.endswith("_min") else F.max if name.endswith("_max") else F.sum


def _from_parts(df: DataFrame, aggs: dict[str, tuple[str, str]]) -> list[Column]:
    """The aggregates from folded parts, in the types of the plain form."""
    kinds = df.groupBy().agg(*[_plain_agg(kind, col).alias(n) for n, (kind, col) in aggs.items()]).schema
    out = []
    for n, (kind, _) in aggs.items():
        value = F.try_divide(f"_{n}_sum", f"_{n}_count") if kind == "avg" else F.col(f"_{n}_{kind}")
        out.append(value.cast(kinds[n].dataType).alias(n))
    return out


def _slide_panes(
    df: DataFrame, ts: str, size: int, step: int, keys: Sequence[str], aggs: dict[str, tuple[str, str]]
) -> DataFrame:
    """Pane form of `slide`.

    A window is named by its last pane position `pos` (window end = (pos + 1) panes). It is generated once, by the
    last non-empty pane it covers. Keys are cut into stretches of `span` panes, each carrying the `m - 1` panes before
    it, so one task's group has a fixed number of panes however many rows or how much time a key has.

    Counts come from one running sum, into which a pane enters and which it leaves. Other aggregates cannot leave again: panes are cut into blocks
    of `m`, and a window is the end of one block and the start of the next, so one scan forwards and one backwards over every block
    give both halves. Either way the cost of a window does not depend on how many panes it covers.
    """
    pane = gcd(size, step)
    m, s = size // pane, step // pane
    span = 16 * m
    parts = _pane_parts(aggs)
    folded = df.groupBy(*keys, F.floor(epoch_us(ts) / F.lit(pane)).alias("_p")).agg(
        *[c.alias(n) for n, c in parts.items()]
    )
    home = F.floor(F.col("_p") / F.lit(span))
    folded = folded.withColumn(
        "_c", F.explode(F.when(F.floor((F.col("_p") + m - 1) / F.lit(span)) > home, F.array(home, home + 1)).otherwise(F.array(home)))
    )
    # A fixed partition count: the panes are few, but each is about to fan out to the windows it closes, so they must
    # not be merged into few tasks by their present size.
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folded = folded.repartition(width, *keys, "_c")
    stretch = Window.partitionBy(*keys, "_c")
    folded = folded.withColumn("_next", F.lead("_p").over(stretch.orderBy("_p")))

    # Window positions this pane is the last non-empty one of, starting on the step grid and inside the stretch.
    first = F.greatest(F.col("_p"), F.col("_c") * span)
    last = F.least(F.col("_p") + (m - 1), F.coalesce(F.col("_next") - 1, F.col("_p") + (m - 1)), (F.col("_c") + 1) * span - 1)
    first = F.ceil((first + 1 - m) / F.lit(s)) * s + m - 1
    ends = F.when(first <= last, F.sequence(first, last, F.lit(s).cast("bigint"))).otherwise(
        F.array().cast("array<bigint>")
    )
    by_count = all(kind == "count" for kind, _ in aggs.values())
    laid = (_by_running_sum if by_count else _by_blocks)(folded, keys, m, ends, list(parts))
    end = from_us((F.col("_pos") + 1) * F.lit(pane)).cast(df.schema[ts].dataType).alias("window_end")
    return laid.where(F.col("_rows") > 0).select(*keys, end, *_from_parts(df, aggs))


def _by_running_sum(folded: DataFrame, keys: Sequence[str], m: int, ends: Column, names: list[str]) -> DataFrame:
    """(keys, _pos, parts) of the windows `ends`: a pane enters at its position and leaves m positions later."""
    at = [F.col("_p"), F.col("_p") + m]
    laid = folded.select(
        *keys, "_c", *names, F.posexplode(F.concat(F.array(*[c.cast("bigint") for c in at]), ends)).alias("_i", "_pos")
    )
    probe = F.col("_i") >= len(at)
    signed = {n: F.when(F.col("_i") == 0, F.col(n)).when(~probe, -F.col(n)) for n in names}
    laid = laid.select(*keys, "_c", "_pos", probe.alias("_probe"), *[c.alias(n) for n, c in signed.items()])
    over = Window.partitionBy(*keys, "_c").orderBy("_pos", "_probe").rowsBetween(Window.unboundedPreceding, 0)
    laid = laid.select(*keys, "_pos", "_probe", *[F.sum(n).over(over).alias(n) for n in names])
    return laid.where("_probe")


def _by_blocks(folded: DataFrame, keys: Sequence[str], m: int, ends: Column, names: list[str]) -> DataFrame:
    """(keys, _pos, parts) of the windows `ends`: the start of their last block scanned forwards, the end of the one before backwards."""
    # Each pane (side 0), each window where it ends (1) and, unless that ends a block, where it starts (2).
    place = F.array(F.struct(F.lit(0).alias("side"), F.col("_p").cast("bigint").alias("at"), F.lit(None).cast("bigint").alias("pos")))
    stops = F.transform(ends, lambda e: F.struct(F.lit(1).alias("side"), e.alias("at"), e.alias("pos")))
    starts = F.transform(
        F.filter(ends, lambda e: F.pmod(e + 1, F.lit(m)) > 0), lambda e: F.struct(F.lit(2).alias("side"), (e + 1 - m).alias("at"), e.alias("pos"))
    )
    laid = folded.select(*keys, "_c", *names, F.explode(F.concat(place, stops, starts)).alias("_e"))
    held = [F.when(F.col("_e.side") == 0, F.col(n)).alias(n) for n in names]
    laid = laid.select(*keys, "_c", "_e.*", F.floor(F.col("_e.at") / F.lit(m)).alias("_b"), *held)
    block = Window.partitionBy(*keys, "_c", "_b").rowsBetween(Window.unboundedPreceding, 0)
    forwards, backwards = block.orderBy("at", "side"), block.orderBy(F.col("at").desc(), "side")
    halves = [F.when(F.col("side") == 1, _part_fold(n)(n).over(forwards)).otherwise(_part_fold(n)(n).over(backwards)).alias(n) for n in names]
    laid = laid.select(*keys, "_c", "side", F.col("pos").alias("_pos"), *halves).where("side > 0")
    # Both halves of a window lie in the same partition already.
    return laid.groupBy(*keys, "_c", "_pos").agg(*[_part_fold(n)(n).alias(n) for n in names])


def session(
    df: DataFrame, ts: str, gap: str, keys: Sequence[str], aggs: dict[str, Column], tie: Sequence[str] = ()
) -> DataFrame:
    """Sessions closed by `gap` without a row. Batch tables number sessions by ordered scan, which a hot key cannot
    overload, and then aggregate per session; streams use Spark's session window."""
    if df.isStreaming:
        out = df.groupBy(F.session_window(F.col(ts), gap).alias("_w"), *keys).agg(
            *[c.alias(n) for n, c in aggs.items()]
        )
        return out.select(
            *keys, F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"), *aggs.keys()
        )
    width = micros(gap)
    order = [ts, *tie]
    hot = find_hot(df, keys) if keys else None
    timed = run_over(df, keys, order, {"_prev": lag(ts)}, hot=hot)
    fresh = F.col("_prev").isNull() | (epoch_us(ts) - epoch_us("_prev") >= width)
    marked = run_over(timed, keys, order, {"_s": run_sum(fresh.cast("bigint"))}, hot=hot)
    out = marked.groupBy(*keys, "_s").agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("_last"), *[c.alias(n) for n, c in aggs.items()]
    )
    end = from_us(epoch_us("_last") + width).cast(df.schema[ts].dataType).alias("session_end")
    return out.select(*keys, "session_start", end, *aggs.keys())


def count_window(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, step: int, agg: Column, name: str
) -> DataFrame:
    """Per key: on every `step`-th row, `agg` of the last at most `size` rows."""
    rows = run_over(df, keys, order, {"row_no": run_count(), name: frame(agg, size - 1)})
    return rows.where(F.col("row_no") % step == 0)


def window_distinct(df: DataFrame, ts: str, size: str, col: str, approx: bool = False, name: str = "uv") -> DataFrame:
    """Distinct values per window. The exact form first groups by (window, value), so no window gathers on one task."""
    w = F.window(F.col(ts), size).alias("_w")
    if approx:
        out = df.groupBy(w).agg(F.approx_count_distinct(col).alias(name))
    elif df.isStreaming:
        out = df.groupBy(w, col).agg(F.count("*").alias("_n")).groupBy("_w").agg(F.count("*").alias(name))
    else:
        out = df.groupBy(w).agg(F.count_distinct(col).alias(name))
    return out.select(F.col("_w.end").alias("window_end"), name)


def bitmap_distinct(
    df: DataFrame, ts: str, size: str, col: str, bits: int = 29, seed: int = 61, name: str = "uv"
) -> DataFrame:
    """Distinct bitmap slots per window: ids that share a slot count once."""
    slots = df.select(ts, bitmap_slot(F.col(col), bits, seed).alias("_slot"))
    return window_distinct(slots, ts, size, "_slot", name=name)


def running_distinct(
    df: DataFrame, ts: str, size: str, col: str, tie: str, bitmap: bool = True, name: str = "uv"
) -> DataFrame:
    """Running distinct count inside each window, one row per value new to the window."""
    value = bitmap_slot(F.col(col)) if bitmap else F.col(col)
    keyed = df.select(ts, tie, value.alias("_v"), F.window(F.col(ts), size)["end"].alias("window_end"))
    firsts = keyed.groupBy("window_end", "_v").agg(F.min(F.struct(ts, tie)).alias("_f"))
    firsts = firsts.select("window_end", F.col("_f")[ts].alias(ts), F.col("_f")[tie].alias(tie))
    return run_over(firsts, ["window_end"], [ts, tie], {name: run_count()})
