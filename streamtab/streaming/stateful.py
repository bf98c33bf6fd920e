"""Keyed processors with state and timers: one definition, run on streams and on batch tables.

A processor sees one key's rows in event-time order. Timers are in epoch milliseconds and fire before the first row
that is later than them, else when the watermark passes them, else (batch) at the end of the data. On a stream rows wait
in state until the watermark has passed them, so disorder within the watermark's delay changes nothing, and what the
watermark has not passed is not processed yet. State is a plain dict of JSON values, kept small by the processor.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from streamtab.functions.times import epoch_us
from streamtab.operators.scan import find_hot, lag, run_over, run_sum

# Keys of a stream share their state in so many buckets, and rows and keys are kept so many to an element of it.
BUCKETS = 1024
PART_ROWS = 4096
_WHOLE = ("byte", "short", "integer", "long")


class KeyedProcessor:
    """Subclass and override; yield output rows as tuples without the key."""

    def on_row(self, row: dict, state: dict, timers: set[int]) -> Iterable[tuple]:
        return ()

    def on_timer(self, at: int, state: dict, timers: set[int]) -> Iterable[tuple]:
        return ()


def _fire(processor: KeyedProcessor, state: dict, timers: set[int], before: int | None) -> Iterator[tuple]:
    """Fire due timers in time order; `before` is exclusive, None fires all that are set."""
    while timers:
        at = min(timers)
        if before is not None and at >= before:
            return
        timers.discard(at)
        yield from processor.on_timer(at, state, timers)


class _StreamRunner(StatefulProcessor):
    """Holds rows back until the watermark passes them, then hands them and due timers to the processor, key by key in one order.

    Its group is a bucket of keys, as every visit to a group's state costs many calls, whatever it holds. A row or timer is due when its
    millisecond is before the watermark: no later row can then come before it. One timer per bucket wakes the runner at the next
    thing due. With `forget_ms` a key's state goes once no row came for so long.
    """

    def __init__(
        self, processor: KeyedProcessor, names: list[str], whole: set[str], keys: list[str], columns: list[str], order: list[str], forget_ms: int | None
    ):
        self.processor, self.names, self.whole, self.columns, self.forget_ms = processor, names, whole, columns, forget_ms
        self.at = names.index("event_ms")
        self.key_of = [names.index(k) for k in keys]
        self.places = [names.index(c) for c in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.wake = handle.getValueState("wake", "at bigint")
        self.kept = handle.getListState("kept", "part binary")
        self.waiting = handle.getListState("waiting", "part binary")

    def _read(self, frame: pd.DataFrame) -> list[tuple]:
        """The rows of a frame as tuples of plain values."""
        columns = []
        for name in self.names:
            values = frame[name].tolist()
            if name in self.whole:
                values = [None if v is None else int(v) for v in values]
            elif frame[name].dtype.kind not in "bi":
                values = [_plain(v) for v in values]
            columns.append(values)
        return list(zip(*columns))

    def _arm(self, due: int | None, armed: int | None) -> None:
        wake = None if due is None else due + 1
        if wake == armed:
            return
        if armed is not None:
            self.handle.deleteTimer(armed)
        if wake is not None:
            self.handle.registerTimer(wake)
            self.wake.update((wake,))
        else:
            self.wake.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh = [row for frame in rows for row in self._read(frame)]
        now = timerValues.getCurrentWatermarkInMs()
        wake = self.wake.get()
        armed = wake[0] if wake else None
        if armed is not None and armed <= now:
            # The bucket would wake in this batch anyway: one visit to its state does both.
            return self._advance(fresh, now, armed)
        self.waiting.appendList(_parts(fresh))
        self._arm(min([r[self.at] for r in fresh] + ([] if armed is None else [armed - 1])), armed)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wake = self.wake.get()
        now = timerValues.getCurrentWatermarkInMs()
        # A timer that fired is spent, and another one of the bucket may have done its work.
        return self._advance([], now, wake[0]) if wake and wake[0] <= now else iter(())

    def _advance(self, fresh: list[tuple], now: int, armed: int) -> Iterator[pd.DataFrame]:
        """Handle what is due of the waiting and the fresh rows; the rest waits on."""
        at = self.at
        held = _whole(self.waiting)
        due: dict[tuple, list[tuple]] = {}
        for row in held:
            if row[at] < now:
                due.setdefault(tuple(row[i] for i in self.key_of), []).append(row)
        later = [r for r in held if r[at] >= now]
        same = len(later) == len(held)
        waits = []
        for row in fresh:
            if row[at] < now:
                due.setdefault(tuple(row[i] for i in self.key_of), []).append(row)
            else:
                waits.append(row)
        # Rows already in state are written again only when some of them leave.
        if not same:
            _put(self.waiting, later + waits)
        elif waits:
            self.waiting.appendList(_parts(waits))
        later += waits
        ahead = {tuple(r[i] for i in self.key_of) for r in later} if self.forget_ms is not None else set()
        next_due = [r[at] for r in later]
        kept = {key: (state, set(timers), last) for key, state, timers, last in _whole(self.kept)}
        for key in due:
            kept.setdefault(key, ({}, set(), None))
        out, left = [], []
        for key, (state, timers, last) in kept.items():
            for row in sorted(due.get(key, ()), key=lambda r: [r[c] for c in self.places]):
                ms = row[at]
                out.extend((*key, *r) for r in _fire(self.processor, state, timers, ms))
                if self.forget_ms is not None and last is not None and ms - last > self.forget_ms:
                    state, timers = {}, set()
                out.extend((*key, *r) for r in self.processor.on_row(dict(zip(self.names, row)), state, timers))
                last = ms
            out.extend((*key, *r) for r in _fire(self.processor, state, timers, now))
            if self.forget_ms is not None and key not in ahead and last is not None and last + self.forget_ms < now:
                state, timers = {}, set()
            if timers:
                next_due.append(min(timers))
            elif state and self.forget_ms is not None and key not in ahead and last is not None:
                next_due.append(last + self.forget_ms)
            if state or timers:
                left.append((key, state, sorted(timers), last))
            if len(out) >= PART_ROWS:
                yield _frame(out, self.columns)
                out = []
        _put(self.kept, left)
        self._arm(min(next_due, default=None), armed)
        if out:
            yield _frame(out, self.columns)

    def close(self) -> None:
        pass


def _parts(rows: list[tuple]) -> list[tuple[bytes]]:
    """Rows as elements of a list state, many in each."""
    return [(pickle.dumps(rows[i : i + PART_ROWS], 5),) for i in range(0, len(rows), PART_ROWS)]


def _whole(state) -> list[tuple]:
    return [row for part in state.get() for row in pickle.loads(part[0])] if state.exists() else []


def _put(state, rows: list[tuple]) -> None:
    if rows:
        state.put(_parts(rows))
    elif state.exists():
        state.clear()


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    """Output rows; a column of whole numbers with nulls stays whole."""
    frame = pd.DataFrame(rows, columns=columns, dtype=object)
    return frame.assign(**{c: frame[c].infer_objects() for c in columns if not frame[c].isna().any()})


def _plain(value):
    """A cell as the Python value that state takes."""
    if value is None or value is pd.NaT or value != value:
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value


def keyed_process(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    processor: KeyedProcessor,
    schema: str,
    silence_ms: int | None = None,
    forget_ms: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Run a processor per key. `order[0]` is the event time; `schema` is the DDL of keys and output columns.

    Batch tables are hash-partitioned and sorted by (keys, order), and each task walks its sorted rows with one key's
    state in memory: no group is gathered. Where a silence longer than `silence_ms` leaves the processor with neither
    state nor timers, say so: a key's stretches between such silences then run apart, which splits a hot key.
    With `forget_ms` a key that had no row for so long loses its state. A stream needs a watermark on `order[0]`; its rows come out
    once the watermark has passed them, and rows without a time are left out. Its keys are dealt over `buckets`, whose state is read and
    written as one: more of them for more keys than a task can hold by the thousandth; the number stays for the life of a checkpoint.
    """
    timed = df.withColumn("event_ms", F.floor(epoch_us(order[0]) / F.lit(1000)))
    columns = [part.strip().split()[0] for part in schema.split(",")]
    if df.isStreaming:
        # A row without a time has no place in the order and no watermark passes it.
        timed = timed.where("event_ms IS NOT NULL")
        names = timed.columns
        # Whole numbers travel as text: one null among them would make the column floating.
        text = {f.name for f in timed.schema.fields if f.dataType.typeName() in _WHOLE and f.name != "event_ms"}
        bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).alias("_bucket")
        timed = timed.select(bucket, *[F.col(n).cast("string").alias(n) if n in text else n for n in names])
        runner = _StreamRunner(processor, names, text, list(keys), columns, list(order), forget_ms)
        return timed.groupBy("_bucket").transformWithStateInPandas(
            statefulProcessor=runner, outputStructType=schema, outputMode="Append", timeMode="EventTime"
        )

    # Whole-number keys travel as text: one null in a batch would make the column floating.
    whole = {k: f"_key{i}" for i, k in enumerate(keys) if timed.schema[k].dataType.typeName() in _WHOLE}
    timed = timed.withColumns({c: F.col(k).cast("string") for k, c in whole.items()})
    read = [lambda row, k=k: None if pd.isna(row[k]) else row[k] for k in keys]
    for i, k in enumerate(keys):
        if k in whole:
            read[i] = lambda row, c=whole[k]: None if row[c] is None else int(row[c])
    groups = list(keys)
    if silence_ms is not None:
        hot = find_hot(timed, keys)
        apart = run_over(timed, keys, order, {"_before": lag("event_ms")}, hot=hot)
        fresh = (F.col("event_ms") - F.col("_before") > silence_ms).cast("bigint")
        timed = run_over(apart, keys, order, {"_stretch": run_sum(F.coalesce(fresh, F.lit(0)))}, hot=hot)
        groups.append("_stretch")
        read.append(lambda row: row["_stretch"])

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, key, state, timers, last = None, (), {}, set(), None
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                group = tuple(of(row) for of in read)
                if group != current:
                    out.extend((*key, *r) for r in _fire(processor, state, timers, None))
                    current, key, state, timers, last = group, group[: len(keys)], {}, set(), None
                out.extend((*key, *r) for r in _fire(processor, state, timers, row["event_ms"]))
                if forget_ms is not None and last is not None and row["event_ms"] - last > forget_ms:
                    state, timers = {}, set()
                last = row["event_ms"]
                out.extend((*key, *r) for r in processor.on_row(row, state, timers))
            yield _frame(out, columns)
        yield _frame([(*key, *r) for r in _fire(processor, state, timers, None)], columns)

    return timed.repartition(*groups).sortWithinPartitions(*groups, *order).mapInPandas(walk, schema)


def _ms(value) -> int:
    return int(value["event_ms"])


class IdleAlert(KeyedProcessor):
    """Emit the time at which a key has been silent for `hold_ms`; each new row cancels the pending timer."""

    def __init__(self, hold_ms: int):
        self.hold_ms = hold_ms

    def on_row(self, row, state, timers):
        timers.clear()
        timers.add(_ms(row) + self.hold_ms)
        return ()

    def on_timer(self, at, state, timers):
        yield (pd.Timestamp(at, unit="ms"),)


class JumpAlert(KeyedProcessor):
    """(current, previous) when two neighbouring values differ by more than the threshold."""

    def __init__(self, col: str, threshold: float):
        self.col, self.threshold = col, threshold

    def on_row(self, row, state, timers):
        last, now = state.get("last"), float(row[self.col])
        state["last"] = now
        if last is not None and abs(last - now) > self.threshold:
            yield (int(row["event_id"]), now, last)


class RunningCount(KeyedProcessor):
    def on_row(self, row, state, timers):
        state["n"] = state.get("n", 0) + 1
        yield (int(row["event_id"]), state["n"])


class LastRows(KeyedProcessor):
    """Count and mean of the current value and at most `preceding` before it."""

    def __init__(self, col: str, preceding: int):
        self.col, self.preceding = col, preceding

    def on_row(self, row, state, timers):
        kept = (state.get("kept", []) + [float(row[self.col])])[-(self.preceding + 1):]
        state["kept"] = kept
        yield (int(row["event_id"]), len(kept), sum(kept) / len(kept))


class RisingAlert(KeyedProcessor):
    """Alert when the value has not fallen for `hold_ms` since a rise; the next rise re-arms."""

    def __init__(self, col: str, hold_ms: int):
        self.col, self.hold_ms = col, hold_ms

    def on_row(self, row, state, timers):
        last, now = state.get("last"), float(row[self.col])
        state["last"] = now
        if last is None or now <= last:
            timers.clear()
        elif not timers:
            timers.add(_ms(row) + self.hold_ms)
        return ()

    def on_timer(self, at, state, timers):
        yield (pd.Timestamp(at - self.hold_ms, unit="ms"), pd.Timestamp(at, unit="ms"))


class FailBurst(KeyedProcessor):
    """Failures from the first one for `hold_ms`; reported with first, last and count when there are enough."""

    def __init__(self, failed: str, hold_ms: int, at_least: int):
        self.failed, self.hold_ms, self.at_least = failed, hold_ms, at_least

    def on_row(self, row, state, timers):
        if not row[self.failed]:
            timers.clear()
            state.clear()
        else:
            if not timers:
                timers.add(_ms(row) + self.hold_ms)
                state.update(first=_ms(row), n=0)
            state.update(last=_ms(row), n=state["n"] + 1)
        return ()

    def on_timer(self, at, state, timers):
        if state["n"] >= self.at_least:
            yield (pd.Timestamp(state["first"], unit="ms"), pd.Timestamp(state["last"], unit="ms"), state["n"])
        state.clear()


class SlotMatcher(KeyedProcessor):
    """Two event kinds of one key with one pending slot each.

    An event whose counterpart is pending makes a pair and empties both slots; otherwise it takes its own slot
    (replacing what was there) and sets a timer. A timer reports and empties whatever is pending.
    """

    def __init__(self, side: str, waits_ms: tuple[int, int]):
        self.side, self.waits_ms = side, waits_ms

    def on_row(self, row, state, timers):
        side = int(row[self.side])
        mine, other = str(side), str(1 - side)
        if other in state:
            pair = (_ms(row), state[other]) if side == 0 else (state[other], _ms(row))
            state.clear()
            yield ("matched", *[pd.Timestamp(x, unit="ms") for x in pair])
        else:
            state[mine] = _ms(row)
            timers.add(_ms(row) + self.waits_ms[side])

    def on_timer(self, at, state, timers):
        if "0" in state:
            yield ("left_only", pd.Timestamp(state["0"], unit="ms"), pd.NaT)
        if "1" in state:
            yield ("right_only", pd.NaT, pd.Timestamp(state["1"], unit="ms"))
        state.clear()


class OrderOutcome(KeyedProcessor):
    """Create/pay state machine of one order: paid in time, paid late, paid without create, never paid."""

    def __init__(self, kind: str, create: str, pay: str, wait_ms: int):
        self.kind, self.create, self.pay, self.wait_ms = kind, create, pay, wait_ms

    def on_row(self, row, state, timers):
        kind, now = row[self.kind], _ms(row)
        if kind == self.create:
            if state.get("paid"):
                state.clear()
                timers.clear()
                yield ("paid",)
            else:
                timers.clear()
                timers.add(now + self.wait_ms)
                state["limit"] = now + self.wait_ms
        elif kind == self.pay:
            if "limit" in state:
                in_time = now < state["limit"]
                state.clear()
                timers.clear()
                yield ("paid" if in_time else "paid_late",)
            else:
                timers.add(now)
                state["paid"] = True

    def on_timer(self, at, state, timers):
        yield ("paid_without_create" if state.get("paid") else "never_paid",)
        state.clear()


class Retract(KeyedProcessor):
    """(is_add, event_id, value): each change withdraws the key's previous row, then adds its own."""

    def on_row(self, row, state, timers):
        if "old" in state:
            yield (int(row["event_id"]), False, *state["old"])
        state["old"] = [int(row["event_id"]), float(row["value"])]
        yield (int(row["event_id"]), True, *state["old"])
