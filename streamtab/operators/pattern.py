"""Event patterns per key, ordered by event time with an explicit tie-break."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtab.functions.times import epoch_us, from_us, micros
from streamtab.operators.over import top_n
from streamtab.operators.scan import Hot, Near, find_hot, hot_limit, is_small, lag, lead, run_count, run_max, run_min, run_over, run_sum
from streamtab.session import ready_checkpoints


def jump_alert(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, threshold: float) -> DataFrame:
    """Rows whose value differs from the key's previous one by more than `threshold`, with both values."""
    seen = run_over(df, keys, order, {"previous": lag(col)})
    return seen.where(F.abs(F.col("previous") - F.col(col)) > threshold)


def consecutive(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    pred: Column,
    n: int,
    within: str,
    inclusive: bool = True,
) -> DataFrame:
    """`n` rows in a row that meet `pred`, first to last within a duration; overlapping runs all count.

    `order[0]` is the event time. Adds `first_ts` and `last_ts` to each run's last row.
    """
    ts = order[0]
    near = {f"_ok{i}": lag("_ok", i) for i in range(1, n)}
    seen = run_over(df.withColumn("_ok", pred), keys, order, {**near, "first_ts": lag(ts, n - 1)})
    hit = F.col("_ok")
    for i in range(1, n):
        hit = hit & F.col(f"_ok{i}")
    span = epoch_us(ts) - epoch_us("first_ts")
    hit = hit & ((span <= micros(within)) if inclusive else (span < micros(within)))
    return seen.where(hit).withColumn("last_ts", F.col(ts)).drop("_ok", *near)


def sequence(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], preds: Sequence[Column], within: str
) -> DataFrame:
    """Rows that meet the predicates one after another with nothing between, first to last in less than `within`."""
    ts, n = order[0], len(preds)
    flagged = df.withColumns({f"_p{i}": p for i, p in enumerate(preds)})

    def ahead(col: str, i: int) -> Near:
        return Near(lambda w: F.lead(col, i).over(w), ahead=i)

    cols = {f"_m{i}": ahead(f"_p{i}", i) for i in range(1, n)}
    seen = run_over(flagged, keys, order, {**cols, "last_ts": ahead(ts, n - 1)})
    hit = F.col("_p0")
    for i in range(1, n):
        hit = hit & F.col(f"_m{i}")
    hit = hit & (epoch_us("last_ts") - epoch_us(ts) < micros(within))
    return seen.where(hit).withColumn("first_ts", F.col(ts)).select(*df.columns, "first_ts", "last_ts")


@dataclass(frozen=True)
class Step:
    """`times` rows that meet `pred`. A strict step's rows each follow the row before with nothing between, a relaxed step's are the next that meet it."""

    pred: Column
    times: int = 1
    strict: bool = False


def unrolled(steps: Sequence[Step]) -> tuple[list[int], list[bool]]:
    """For every row of a match, in order: its step, and whether it must follow the row before at once."""
    return [i for i, s in enumerate(steps) for _ in range(s.times)], [s.strict for s in steps for _ in range(s.times)]


def match_steps(df: DataFrame, keys: Sequence[str], order: Sequence[str], steps: Sequence[Step], within: str, inclusive: bool = False) -> DataFrame:
    """(keys, last column of `order`, at): the first row of every match and the times of all its rows in microseconds since the epoch.

    Every row that meets the first step opens a match, which goes on with the next fitting row and is dropped where a strict step fails or when it
    is not done in less than `within` (`inclusive`: at most). `order` starts with the event time and ends with a tie-break. Rows without a
    time are left out; a null condition is not met. Times are carried from the last step back to the first, by one ordered scan a step.
    """
    places, strict = unrolled(steps)
    kept = df.where(F.col(order[0]).isNotNull()).withColumns({f"_p{i}": F.coalesce(s.pred, F.lit(False)) for i, s in enumerate(steps)})
    flags = [f"_p{i}" for i in range(len(steps))]
    kept = kept.withColumn("_us", epoch_us(order[0])).select(*dict.fromkeys([*keys, *order]), "_us", *flags)
    if not any(strict):
        kept = kept.where(F.greatest(*flags, F.lit(False)))
    hot = find_hot(kept, keys)
    seen = run_over(kept, keys, order, {"_n": run_count()}, hot=hot)
    own = F.array("_us")
    seen = seen.withColumn("_at", F.when(F.col(flags[places[-1]]), own))
    for place, after, at_once in zip(places[-2::-1], places[:0:-1], strict[:0:-1]):
        if at_once:
            seen = run_over(seen, keys, order, {"_ahead": lead("_at")}, hot=hot)
        else:
            # The next row that meets the step is taken even where the match fails later on.
            nearest = F.when(F.col(flags[after]), F.struct("_n", "_at"))
            seen = run_over(seen, keys, order, {"_near": run_min(nearest, backward=True)}, hot=hot)
            seen = run_over(seen.drop("_at"), keys, order, {"_next": lead("_near")}, hot=hot)
            seen = seen.withColumn("_ahead", F.col("_next._at")).drop("_near", "_next")
        seen = seen.withColumn("_at", F.when(F.col(flags[place]), F.concat(own, "_ahead"))).drop("_ahead")
    took = F.element_at("_at", -1) - F.element_at("_at", 1)
    done = took <= micros(within) if inclusive else took < micros(within)
    return seen.where(done).select(*dict.fromkeys([*keys, order[-1]]), F.col("_at").alias("at"))


def followed_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column, then: Column, within: str
) -> DataFrame:
    """Each `first` row with the next `then` row of its key, other rows allowed between.

    status `matched` (with `then_ts`) when it comes in less than `within`; otherwise `timeout` at `deadline`, provided
    the data reaches that far.
    """
    ts = order[0]
    end = df.agg(F.max(ts)).first()[0]
    kept = df.where(first | then).withColumns({"_a": first, "_b": then})
    after = run_min(F.when(F.col("_b") & ~F.col("_a"), F.col(ts)), backward=True)
    seen = run_over(kept, keys, order, {"then_ts": after}).where("_a")
    limit = epoch_us(ts) + micros(within)
    met = F.coalesce(epoch_us("then_ts") < limit, F.lit(False))
    deadline = from_us(limit).cast(df.schema[ts].dataType)
    out = seen.withColumn("status", F.when(met, "matched").otherwise("timeout")).withColumns(
        {"then_ts": F.when(met, F.col("then_ts")), "deadline": deadline}
    )
    reached = F.col("deadline") <= F.lit(end).cast(df.schema[ts].dataType)
    return out.where(met | reached).select(*df.columns, "then_ts", "deadline", "status")


def order_outcome(df: DataFrame, keys: Sequence[str], order: Sequence[str], create: Column, pay: Column, within: str) -> DataFrame:
    """(keys, result_state): every outcome of an order's creates and pays in time order, as the keyed processor `OrderOutcome` gives them on streams.

    A create waits for a pay until its deadline, a later create takes its place, a pay without a create waits for one of its own millisecond.
    Whatever else comes later finds the order empty. `order` starts with the event time and ends with a tie-break; rows without a time are
    left out. A row either leaves the order open whatever was before it, or turns open into empty and empty into open, so a state is
    the parity of the turns since the last row of the first kind: running counts, which cut a hot order into chunks.
    """
    wait = F.lit(micros(within) // 1000)
    kept = df.where((create | pay) & F.col(order[0]).isNotNull())
    kept = kept.withColumns({"_made": F.coalesce(create, F.lit(False)), "_ms": F.floor(epoch_us(order[0]) / F.lit(1000))})
    kept = kept.select(*dict.fromkeys([*keys, *order, "_made", "_ms"]))
    hot = find_hot(kept, keys)
    near = {"_was": lag("_made"), "_then": lag("_ms"), "_next": lead("_ms"), "_made_next": lead("_made")}
    seen = run_over(kept, keys, order, {**near, "_n": run_count()}, hot=hot)
    since = F.col("_ms") - F.col("_then")
    turns = F.when(F.col("_made"), ~F.col("_was") & (since == 0)).otherwise(F.col("_was") & (since <= wait))
    seen = seen.withColumn("_turns", F.coalesce(turns, F.lit(False)))
    seen = run_over(seen, keys, order, {"_base": run_max(F.when(~F.col("_turns"), F.col("_n")))}, hot=hot)
    open_after = (F.col("_n") - F.col("_base")) % 2 == 0
    ahead = F.col("_next") - F.col("_ms")
    waiting = F.when(ahead.isNull() | (ahead > wait), "never_paid").when(F.col("_made_next"), None).when(ahead < wait, "paid").otherwise("paid_late")
    stray = F.when(ahead.isNull() | (ahead > 0), "paid_without_create").when(F.col("_made_next"), "paid")
    out = seen.where(open_after).withColumn("result_state", F.when(F.col("_made"), waiting).otherwise(stray))
    return out.where(F.col("result_state").isNotNull()).select(*keys, "result_state")


def first_outcome(df: DataFrame, key: str, ts: str, create: Column, pay: Column, within: str) -> DataFrame:
    """One outcome per order from its first create and first pay, whatever came between or later."""
    times = df.groupBy(key).agg(
        F.min(F.when(create, F.col(ts))).alias("create_ts"), F.min(F.when(pay, F.col(ts))).alias("pay_ts")
    )
    in_time = epoch_us("pay_ts") < epoch_us("create_ts") + micros(within)
    state = (
        F.when(F.col("create_ts").isNull() & F.col("pay_ts").isNull(), F.lit(None).cast("string"))
        .when(F.col("create_ts").isNull(), "paid_without_create")
        .when(F.col("pay_ts").isNull(), "never_paid")
        .when(in_time, "paid")
        .otherwise("paid_late")
    )
    return times.withColumn("result_state", state).where(F.col("result_state").isNotNull())


def fix_new_flag(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str) -> DataFrame:
    """Set a repeated new-visitor flag '1' to '0': only a key's first flagged row keeps it.

    `first_visit` is the day of that first row, for the rows from it on.
    """
    isnew = F.col(flag) == "1"
    ts = order[0]
    seen = run_over(
        df,
        keys,
        order,
        {"_seen": run_sum(isnew.cast("bigint")), "_first": run_min(F.when(isnew, F.col(ts)))},
    )
    fixed = F.when(isnew & (F.col("_seen") > 1), "0").otherwise(F.col(flag))
    return seen.withColumns({flag: fixed, "first_visit": F.date_format("_first", "yyyy-MM-dd")}).drop("_seen", "_first")


def first_of_day(df: DataFrame, keys: Sequence[str], order: Sequence[str], zone: str = "UTC") -> DataFrame:
    """The first row per key and day. Every task cuts to one row per (key, day) before the shuffle."""
    day = F.to_date(F.from_utc_timestamp(F.col(order[0]).cast("timestamp"), zone))
    kept = top_n(df.withColumn("_day", day), [*keys, "_day"], [F.col(c) for c in order], 1, "_rank")
    return kept.drop("_rank", "_day")


def cap_per_day(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int, zone: str = "UTC"
) -> tuple[DataFrame, DataFrame]:
    """(rows within the daily limit per key, one warning row per key and day that went over it)."""
    day = F.to_date(F.from_utc_timestamp(F.col(order[0]).cast("timestamp"), zone))
    ranked = top_n(df.withColumn("day", day), [*keys, "day"], [F.col(c) for c in order], limit + 1, "_rank")
    passed = ranked.where(F.col("_rank") <= limit).drop("_rank", "day")
    warned = ranked.where(F.col("_rank") == limit + 1).select(
        *keys, "day", F.lit(f"click over {limit} times.").alias("warning_msg")
    )
    return passed, warned


def _greedy_starts(df: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Rows (keys, `_n`, `_t`; `_n` dense per group from 1) kept by: the first, then always the first with `_t` more
    than `width` after the last kept. Adds `_next`, the row number of the following kept row (null at the end).

    The next kept row of *every* row is one ordered scan. Which rows the chain from row 1 visits is found by pointer
    doubling: in round r the known rows reach 2**r steps further. Rounds grow with the logarithm of the longest chain,
    and all joins are on (keys, row number), so a single endless group is spread evenly.
    """
    ready_checkpoints(df.sparkSession)
    targets = df.select(*keys, F.col("_t").alias("_at"), F.lit(0).alias("_probe"), F.col("_n").alias("_row"))
    probes = df.select(*keys, (F.col("_t") + width).alias("_at"), F.lit(1).alias("_probe"), F.col("_n").alias("_row"))
    seen = run_over(
        targets.unionByName(probes),
        keys,
        ["_at", "_probe", "_row"],
        {"_next": run_min(F.when(F.col("_probe") == 0, F.col("_row")), backward=True)},
    )
    hops = seen.where("_probe = 1").select(*keys, F.col("_row").alias("_n"), "_next").checkpoint()
    longest = df.groupBy(*keys).agg((F.max("_t") - F.min("_t")).alias("_s")).agg(F.max("_s")).first()[0]
    rounds = max(1, ceil(log2((longest or 0) / max(width, 1) + 2)))
    reached = hops.where("_n = 1").select(*keys, "_n")
    jump = hops.where(F.col("_next").isNotNull())
    for _ in range(rounds):
        stepped = reached.join(jump, [*keys, "_n"]).select(*keys, F.col("_next").alias("_n"))
        reached = reached.unionByName(stepped).distinct().checkpoint()
        far = jump.select(*keys, F.col("_n").alias("_next"), F.col("_next").alias("_far"))
        jump = jump.join(far, [*keys, "_next"]).select(*keys, "_n", F.col("_far").alias("_next")).checkpoint()
    return reached.join(hops, [*keys, "_n"])


def anchored_runs(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], member: Column, width: str, hot: Hot | None = None
) -> DataFrame:
    """Timed runs of `member` rows: a run starts at a member row when none is pending and lasts `width`.

    Any other row of the key that comes up to the end of that time cancels the pending run. Gives each run's
    `start_ts`, `last_ts` (last member row inside it), `n` (member rows inside it) and `cancelled`.
    """
    ts, span = order[0], micros(width)
    base = df.withColumns({"_m": F.coalesce(member, F.lit(False)), "_t": epoch_us(ts)})
    hot = hot or find_hot(df, keys)
    breaks = run_min(F.when(~F.col("_m"), F.col("_t")), backward=True)
    near = run_over(base, keys, order, {"_pm": lag("_m"), "_pt": lag("_t"), "_breaks": breaks}, hot=hot)
    # A member row after a non-member, or more than `width` after the previous row, always starts a run.
    opens = F.col("_m") & (F.col("_pm").isNull() | ~F.col("_pm") | (F.col("_t") - F.col("_pt") > span))
    marked = near.withColumn("_open", opens.cast("bigint"))
    islands = run_over(marked, keys, order, {"_island": run_sum(F.col("_open"))}, hot=hot).where("_m")

    ready_checkpoints(df.sparkSession)
    tie = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    okeys = [f"_o{i}" for i in range(len(order))]
    # One struct as island key: equal also where a key field is null.
    members = islands.select(
        F.struct(*keys, "_island").alias("_kk"), "_t", "_open", F.col("_breaks").alias("_break"), *tie
    ).checkpoint()
    sums = members.groupBy("_kk").agg(
        F.min("_t").alias("_s"), F.max("_t").alias("_l"), F.count("*").alias("n"), F.max("_break").alias("_break")
    )
    runs = sums.where(F.col("_l") - F.col("_s") <= span)
    long = sums.where(F.col("_l") - F.col("_s") > span).select("_kk", "n").checkpoint()
    limit = hot_limit(df.sparkSession)
    usual, endless = long.where(F.col("n") <= limit), long.where(F.col("n") > limit)
    if not usual.isEmpty():
        runs = runs.unionByName(_walked_runs(members.join(usual, "_kk", "left_semi"), okeys, span))
    if not endless.isEmpty():
        # Endless islands number at most rows / limit.
        side = F.broadcast(endless) if is_small(endless) else endless
        runs = runs.unionByName(_chained_runs(members.join(side, "_kk", "left_semi"), okeys, span))
    kind = df.schema[ts].dataType
    return runs.select(
        *[F.col("_kk")[k].alias(k) for k in keys],
        from_us(F.col("_s")).cast(kind).alias("start_ts"),
        from_us(F.col("_l")).cast(kind).alias("last_ts"),
        "n",
        F.coalesce(F.col("_break") <= F.col("_s") + span, F.lit(False)).alias("cancelled"),
    )


def _walked_runs(members: DataFrame, order: Sequence[str], span: int) -> DataFrame:
    """Runs of islands of ordinary size: each task walks its sorted rows once, carrying one start time."""

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start = 0
        for batch in batches:
            t, opens = batch["_t"].to_numpy(), batch["_open"].to_numpy()
            bounds = [0, *(np.flatnonzero(opens[1:]) + 1), len(t)]
            starts = np.empty(len(t), dtype="int64")
            for lo, hi in zip(bounds, bounds[1:]):
                if hi > lo and opens[lo]:
                    start = t[lo]
                while lo < hi:
                    stop = lo + int(np.searchsorted(t[lo:hi], start + span, side="right"))
                    starts[lo:stop] = start
                    if stop < hi:
                        start = t[stop]
                    lo = stop
            yield batch.assign(_s=starts)

    fields = members.schema["_kk"].dataType.fields
    flat = [f"_k{i}" for i in range(len(fields))]
    parts = [F.col("_kk")[f.name].alias(c) for c, f in zip(flat, fields)]
    # Sorted by a hash first: an island only has to be contiguous, and a long compares faster than the key.
    spread = members.select(*parts, F.xxhash64("_kk").alias("_h"), "_t", "_open", "_break", *order)
    laid = spread.repartition("_h").sortWithinPartitions("_h", *flat, *order).select(*flat, "_t", "_open", "_break")
    keys = ", ".join(f"{c} {f.dataType.simpleString()}" for c, f in zip(flat, fields))
    done = laid.mapInPandas(label, f"{keys}, _t bigint, _open bigint, _break bigint, _s bigint")
    runs = done.groupBy(*flat, "_s").agg(F.max("_t").alias("_l"), F.count("*").alias("n"), F.max("_break").alias("_break"))
    island = F.struct(*[F.col(c).alias(f.name) for c, f in zip(flat, fields)])
    return runs.select(island.alias("_kk"), "_s", "_l", "n", "_break")


def _chained_runs(members: DataFrame, order: Sequence[str], span: int) -> DataFrame:
    """Runs of islands too long for one task, by pointer doubling over row numbers."""
    numbered = run_over(members, ["_kk"], order, {"_n": run_count()})
    rows = numbered.select("_kk", "_n", "_t", "_break").checkpoint()
    size = rows.groupBy("_kk").agg((F.max("_n") + 1).alias("_size")).checkpoint()
    size = F.broadcast(size) if is_small(size) else size
    starts = _greedy_starts(rows.select("_kk", "_n", "_t"), ["_kk"], span).join(size, "_kk")
    stop = F.coalesce(F.col("_next"), F.col("_size"))
    starts = starts.select("_kk", "_n", (stop - 1).alias("_stop"), (stop - F.col("_n")).alias("n"))
    heads = starts.join(rows, ["_kk", "_n"]).select("_kk", F.col("_t").alias("_s"), "_stop", "n", "_break")
    tails = rows.select("_kk", F.col("_n").alias("_stop"), F.col("_t").alias("_l"))
    return heads.join(tails, ["_kk", "_stop"]).select("_kk", "_s", "_l", "n", "_break")


def fail_burst(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], failed: Column, width: str, at_least: int = 2
) -> DataFrame:
    """Failures gathered from the first one for `width`, reported when there are `at_least`; a success clears them."""
    runs = anchored_runs(df, keys, order, failed, width)
    return runs.where(~F.col("cancelled") & (F.col("n") >= at_least)).drop("cancelled")


def rising_alert(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, hold: str) -> DataFrame:
    """Alert at the time a value has not fallen for `hold` since a rise; the next rise after an alert re-arms it."""
    ts = order[0]
    hot = find_hot(df, keys)
    seen = run_over(df, keys, order, {"_before": lag(col)}, hot=hot)
    runs = anchored_runs(seen, keys, order, F.col(col) > F.col("_before"), hold, hot)
    fired = from_us(epoch_us("start_ts") + micros(hold)).cast(df.schema[ts].dataType)
    return runs.where(~F.col("cancelled")).select(*keys, F.col("start_ts").alias("rise_ts"), fired.alias("alert_ts"))
