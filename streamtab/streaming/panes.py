"""Long sliding windows on streams: two stateful steps, panes first, then a ring of pane totals per key.

Spark's own windowed aggregate folds rows into panes of the greatest common divisor of size and step, combining before the shuffle, and hands
on each pane when the watermark has passed it. A keyed step holds the panes of one window length and emits every window that has
closed. No row is copied into the windows that cover it, and a key's state is at most size / pane totals plus those of
the panes that arrived since the last wake-up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructType

from streamtab.functions.times import epoch_us, from_us, micros
from streamtab.operators.windows import _from_parts, _pane_parts


def _fold(name: str) -> tuple[np.ufunc, float]:
    """How parts combine, and what an empty pane holds."""
    if name.endswith("_min"):
        return np.minimum, np.inf
    return (np.maximum, -np.inf) if name.endswith("_max") else (np.add, 0)


def block_windows(values: np.ndarray, m: int, fold: np.ufunc, empty: float) -> np.ndarray:
    """The fold of every `m` values in a row, by a scan forwards and one backwards over blocks of `m`: entry i ends at values[i + m - 1]."""
    if m == 1:
        return values
    n = len(values) - m + 1
    blocks = np.concatenate([values, np.full(-len(values) % m, empty, values.dtype)]).reshape(-1, m)
    forwards = fold.accumulate(blocks, axis=1).ravel()
    backwards = fold.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    out = forwards[m - 1 : m - 1 + n].copy()
    inside = np.arange(n) % m > 0
    out[inside] = fold(backwards[:n][inside], out[inside])
    return out


def closed_windows(places: np.ndarray, parts: dict[str, np.ndarray], m: int, s: int, after: int, upto: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(positions, totals) of the non-empty windows that end at panes after `after` and up to `upto`, from sorted panes.

    A window is named by its last pane and starts on the grid of `s` panes. Panes more than a window apart share none, so
    each stretch between such gaps is laid out by itself.
    """
    positions, totals = [], {n: [] for n in parts}
    for run in np.split(np.arange(len(places)), np.flatnonzero(np.diff(places) >= m) + 1):
        if not len(run):
            continue
        low, high = max(int(places[run[0]]), after + 1), min(int(places[run[-1]]) + m - 1, upto)
        # First window end of the stretch whose start is on the grid.
        low += -(low + 1 - m) % s
        if low > high:
            continue
        ends = np.arange(low, high + 1, s)
        offset, width = low - m + 1, high - low + m
        at = places[run] - offset
        inside = (at >= 0) & (at < width)
        held = np.zeros(width, np.int64)
        held[at[inside]] = 1
        full = block_windows(held, m, np.add, 0)[::s] > 0
        positions.append(ends[full])
        for n, values in parts.items():
            fold, empty = _fold(n)
            whole = values.dtype.kind == "i" and fold is np.add
            laid = np.full(width, 0 if whole else empty, values.dtype if whole else np.float64)
            laid[at[inside]] = values[run][inside]
            totals[n].append(block_windows(laid, m, fold, empty)[::s][full])
    if not positions:
        return np.empty(0, np.int64), {n: np.empty(0, values.dtype) for n, values in parts.items()}
    return np.concatenate(positions), {n: np.concatenate(t) for n, t in totals.items()}


class _Ring(StatefulProcessor):
    """The panes of one window length of a key; wakes when its next window closes and emits all that have closed by then."""

    def __init__(self, names: list[str], whole: list[bool], m: int, s: int, pane_us: int, columns: list[str]):
        self.names, self.whole, self.m, self.s, self.pane_us, self.columns = names, whole, m, s, pane_us, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        lists = ", ".join(f"{n} array<{'bigint' if w else 'double'}>" for n, w in zip(self.names, self.whole))
        self.ring = handle.getValueState("ring", f"places array<bigint>, {lists}, done bigint, wake bigint")

    def _load(self) -> tuple[np.ndarray, dict[str, np.ndarray], int | None, int | None]:
        kept = self.ring.get() if self.ring.exists() else None
        kinds = [np.int64 if w else np.float64 for w in self.whole]
        if kept is None:
            return np.empty(0, np.int64), {n: np.empty(0, k) for n, k in zip(self.names, kinds)}, None, None
        return np.array(kept[0], np.int64), {n: np.array(v, k) for n, v, k in zip(self.names, kept[1:-2], kinds)}, kept[-2], kept[-1]

    def _close_ms(self, place: int) -> int:
        """The millisecond at which the window that ends with this pane is over."""
        return -(-(place + 1) * self.pane_us // 1000)

    def _store(self, places: np.ndarray, parts: dict[str, np.ndarray], done: int | None, armed: int | None) -> None:
        wake = None
        if len(places):
            nearest = max(int(places[0]), done + 1 if done is not None else int(places[0]))
            nearest += -(nearest + 1 - self.m) % self.s
            wake = self._close_ms(nearest)
        if armed != wake:
            if armed is not None:
                self.handle.deleteTimer(armed)
            if wake is not None:
                self.handle.registerTimer(wake)
        if len(places):
            self.ring.update((places.tolist(), *[parts[n].tolist() for n in self.names], done, wake))
        elif self.ring.exists():
            self.ring.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        places, parts, done, armed = self._load()
        for frame in rows:
            places = np.concatenate([places, frame["place"].to_numpy(np.int64)])
            for n, w in zip(self.names, self.whole):
                fresh = frame[f"p{n}"].to_numpy(np.int64) if w else frame[f"p{n}"].to_numpy(np.float64, na_value=_fold(n)[1])
                parts[n] = np.concatenate([parts[n], fresh])
        order = np.argsort(places, kind="stable")
        self._store(places[order], {n: v[order] for n, v in parts.items()}, done, armed)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        places, parts, done, _ = self._load()
        upto = timerValues.getCurrentWatermarkInMs() * 1000 // self.pane_us - 1
        first = int(places[0]) - 1 if len(places) else upto
        ends, totals = closed_windows(places, parts, self.m, self.s, first if done is None else done, upto)
        # A pane stays while a window that covers it is open.
        kept = places > upto - self.m + 1
        self._store(places[kept], {n: v[kept] for n, v in parts.items()}, upto, None)
        if len(ends):
            frame = pd.DataFrame(dict(zip(self.columns, zip(*[key] * len(ends)))) if key else {})
            frame["_pos"] = ends
            for n in self.names:
                values = totals[n]
                frame[n] = values if values.dtype.kind == "i" else pd.Series(values).where(np.isfinite(values))
            yield frame[self.columns]

    def close(self) -> None:
        pass


def slide_stream(df: DataFrame, ts: str, size: str, step: str, keys: Sequence[str], aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """Sliding windows of a watermarked stream, each emitted once when the watermark has passed its end; the rows and types of `slide`.

    `aggs` is name -> (count|sum|min|max|avg, column or '*') as there. A pane without a value of a column adds nothing to it; sums, least and
    greatest values are doubles on the way, so whole numbers stay exact up to 2^53.
    """
    width, hop = micros(size), micros(step)
    pane = gcd(width, hop)
    m, s = width // pane, hop // pane
    parts = _pane_parts(aggs)
    # Non-null values behind a sum, so that none gives null and not zero.
    filled = {f"_{n}_sum": f"_{n}_filled_count" for n, (kind, _) in aggs.items() if kind == "sum"}
    parts |= {f"_{n}_filled_count": F.count(col) for n, (kind, col) in aggs.items() if kind == "sum"}
    names = list(parts)
    grouped = df.groupBy(F.window(F.col(ts), f"{pane} microseconds").alias("_w"), *keys).agg(*[c.alias(n) for n, c in parts.items()])
    whole = [isinstance(grouped.schema[n].dataType, LongType) and n.endswith(("_count", "_rows")) for n in names]
    kinds = {n: "bigint" if w else "double" for n, w in zip(names, whole)}
    place = F.floor(epoch_us(F.col("_w.start")) / F.lit(pane)).alias("place")
    # Rows reach the processor as named tuples, in which a name cannot start with an underscore.
    timed = grouped.select(*keys, F.window_time("_w").alias("closing"), place, *[F.col(n).cast(k).alias(f"p{n}") for n, k in kinds.items()])
    own = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in StructType([timed.schema[k] for k in keys]).fields)
    schema = ", ".join(filter(None, [own, "_pos bigint", *[f"{n} {k}" for n, k in kinds.items()]]))
    ring = _Ring(names, whole, m, s, pane, [*keys, "_pos", *names])
    if not keys:
        # One key for the whole stream: panes were combined before, so it sees one row a pane.
        timed, schema, ring.columns = timed.withColumn("everything", F.lit(0)), "everything int, " + schema, ["everything", *ring.columns]
    out = timed.groupBy(*(keys or ["everything"])).transformWithStateInPandas(statefulProcessor=ring, outputStructType=schema, outputMode="Append", timeMode="EventTime")
    out = out.withColumns({n: F.when(F.col(c) > 0, F.col(n)) for n, c in filled.items()})
    end = from_us((F.col("_pos") + 1) * F.lit(pane)).cast(df.schema[ts].dataType).alias("window_end")
    return out.select(*keys, end, *_from_parts(df, aggs))
