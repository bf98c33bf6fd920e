"""Processors for the pattern, window and rolling jobs on streams. Times are in milliseconds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtab.functions.times import epoch_us, micros
from streamtab.operators.pattern import Step, unrolled
from streamtab.streaming.stateful import KeyedProcessor, keyed_process

DAY_MS = 86_400_000


def _at(ms: int) -> pd.Timestamp:
    return pd.Timestamp(ms, unit="ms")


class CapPerDay(KeyedProcessor):
    """(event_id, 'passed') for the first `limit` rows of a day, (event_id, 'warned') once when there is one more."""

    def __init__(self, limit: int, zone_ms: int = 0):
        self.limit, self.zone_ms = limit, zone_ms

    def on_row(self, row, state, timers):
        day = (row["event_ms"] + self.zone_ms) // DAY_MS
        if state.get("day") != day:
            state.update(day=day, n=0)
        state["n"] += 1
        if state["n"] <= self.limit + 1:
            yield (int(row["event_id"]), "passed" if state["n"] <= self.limit else "warned")


class FixNewFlag(KeyedProcessor):
    """(event_id, flag, first visit): '1' only on the key's first row that says so; later claims become '0'."""

    def __init__(self, flag: str):
        self.flag = flag

    def fixed(self, row, state) -> str | None:
        flag = row[self.flag]
        if flag == "1":
            flag = "0" if "first" in state else "1"
            state.setdefault("first", str(_at(row["event_ms"]).date()))
        return flag

    def on_row(self, row, state, timers):
        flag = self.fixed(row, state)
        yield (int(row["event_id"]), flag, state.get("first"))


class DailyVisit(FixNewFlag):
    """(event_id, flag, time) of the first page row of each day, after its flag was mended."""

    def __init__(self, flag: str, page: str):
        super().__init__(flag)
        self.page = page

    def on_row(self, row, state, timers):
        flag = self.fixed(row, state)
        day = row["event_ms"] // DAY_MS
        if row[self.page] and state.get("day") != day:
            state["day"] = day
            yield (int(row["event_id"]), flag, _at(row["event_ms"]))


class FollowedBy(KeyedProcessor):
    """(event_id, then, deadline, status): each opening row with the next closing row in time, or a timeout at its deadline."""

    def __init__(self, opens: str, closes: str, wait_ms: int):
        self.opens, self.closes, self.wait_ms = opens, closes, wait_ms

    def on_row(self, row, state, timers):
        now, held = row["event_ms"], state.get("held", [])
        if row[self.closes]:
            for event, at in held:
                if now < at + self.wait_ms:
                    yield (event, _at(now), _at(at + self.wait_ms), "matched")
            held = [h for h in held if now >= h[1] + self.wait_ms]
        if row[self.opens]:
            held = [*held, [int(row["event_id"]), now]]
            timers.add(now + self.wait_ms)
        state["held"] = held
        if not held:
            state.clear()
            timers.clear()

    def on_timer(self, at, state, timers):
        for event, begun in state.get("held", []):
            if begun + self.wait_ms == at:
                yield (event, pd.NaT, _at(at), "timeout")
        state["held"] = [h for h in state.get("held", []) if h[1] + self.wait_ms != at]
        if not state["held"]:
            state.clear()


class Consecutive(KeyedProcessor):
    """(event_id, first, last) of every `n` rows in a row for which `hit` holds, within `within_ms`."""

    def __init__(self, hit: str, n: int, within_ms: int, inclusive: bool = True):
        self.hit, self.n, self.within_ms, self.inclusive = hit, n, within_ms, inclusive

    def on_row(self, row, state, timers):
        if not row[self.hit]:
            state.clear()
            return
        last = (state.get("last", []) + [row["event_ms"]])[-self.n :]
        state["last"] = last
        gap = last[-1] - last[0]
        if len(last) == self.n and (gap < self.within_ms or self.inclusive and gap == self.within_ms):
            yield (int(row["event_id"]), _at(last[0]), _at(last[-1]))


class StrictSequence(KeyedProcessor):
    """(first event_id, first, last) of rows whose `kind` values follow each other without another row between."""

    def __init__(self, kind: str, steps: Sequence[str], within_ms: int):
        self.kind, self.steps, self.within_ms = kind, list(steps), within_ms

    def on_row(self, row, state, timers):
        last = (state.get("last", []) + [[row[self.kind], int(row["event_id"]), row["event_ms"]]])[-len(self.steps) :]
        state["last"] = last
        if [k for k, _, _ in last] == self.steps and last[-1][2] - last[0][2] < self.within_ms:
            yield (last[0][1], _at(last[0][2]), _at(last[-1][2]))


class CountWindow(KeyedProcessor):
    """(event_id, row number, value) on every `step`-th row: `fold` of the last at most `size` values."""

    def __init__(self, col: str, size: int, step: int, fold: Callable[[list[float]], float]):
        self.col, self.size, self.step, self.fold = col, size, step, fold

    def on_row(self, row, state, timers):
        state["n"] = state.get("n", 0) + 1
        state["kept"] = (state.get("kept", []) + [float(row[self.col])])[-self.size :]
        if state["n"] % self.step == 0:
            yield (int(row["event_id"]), state["n"], self.fold(state["kept"]))


class Rolling(KeyedProcessor):
    """(event_id, row number, sum, maximum, event that holds the maximum): what is known after each row; the earlier holder stays on a tie."""

    def __init__(self, col: str):
        self.col = col

    def on_row(self, row, state, timers):
        value, event = float(row[self.col]), int(row["event_id"])
        state["n"], state["sum"] = state.get("n", 0) + 1, state.get("sum", 0.0) + value
        if "best" not in state or value > state["best"]:
            state.update(best=value, holder=event)
        yield (event, state["n"], state["sum"], state["best"], state["holder"])


class TopValues(KeyedProcessor):
    """(event_id, rank, value): the `k` largest positive values again, each time a row changes them."""

    def __init__(self, col: str, k: int = 2):
        self.col, self.k = col, k

    def on_row(self, row, state, timers):
        value, top = float(row[self.col]), state.get("top", [])
        after = sorted([*top, value], reverse=True)[: self.k] if value > 0 else top
        if after != top:
            state["top"] = after
            for rank, held in enumerate(after, 1):
                yield (int(row["event_id"]), rank, held)


class StepMatch(KeyedProcessor):
    """(first row's id, times) of every match of `hits`, one flag column a row of the match; see `match_steps`.

    Matches that wait for the same row are held together and move on together. What can no longer end in time goes with the next row or timer.
    """

    def __init__(self, id_col: str, hits: Sequence[str], strict: Sequence[bool], within_us: int, inclusive: bool = False):
        self.id_col, self.hits, self.strict = id_col, list(hits), list(strict)
        # A match may take less than this.
        self.limit = within_us + inclusive

    def on_row(self, row, state, timers):
        now, last = row["event_us"], len(self.hits) - 1
        # Per row of the match: those that wait for it.
        held = state.get("held") or [[] for _ in self.hits]
        held = [[m for m in group if now - m[1][0] < self.limit] for group in held]
        for place in range(last, 0, -1):
            if row[self.hits[place]]:
                moved = [[key, [*at, now]] for key, at in held[place]]
                held[place] = []
                if place == last:
                    yield from ((key, at) for key, at in moved)
                else:
                    held[place + 1] += moved
            elif self.strict[place]:
                held[place] = []
        if row[self.hits[0]]:
            if last:
                held[1].append([row[self.id_col], [now]])
            else:
                yield (row[self.id_col], [now])
        timers.clear()
        if any(held):
            state["held"] = held
            timers.add(row["event_ms"] + self.limit // 1000 + 1)
        else:
            state.clear()

    def on_timer(self, at, state, timers):
        # Set by the last row, which is younger than all that waits.
        state.clear()
        return ()


def match_steps(df: DataFrame, keys: Sequence[str], order: Sequence[str], steps: Sequence[Step], within: str, inclusive: bool = False) -> DataFrame:
    """The rows of `operators.pattern.match_steps` from a watermarked stream, each once its last row is behind the watermark."""
    places, strict = unrolled(steps)
    flags = {f"hit{i}": F.coalesce(s.pred, F.lit(False)) for i, s in enumerate(steps)}
    rows = df.withColumns({"event_us": epoch_us(order[0]), **flags}).select(*dict.fromkeys([*keys, *order]), "event_us", *flags)
    if not any(strict):
        rows = rows.where(F.greatest(*flags, F.lit(False)))
    machine = StepMatch(order[-1], [f"hit{i}" for i in places], strict, micros(within), inclusive)
    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in [*keys, order[-1]])
    return keyed_process(rows, keys, order, machine, f"{schema}, at array<bigint>")
