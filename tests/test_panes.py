"""Sliding windows by panes on streams: the pane arithmetic by itself, then against the batch form."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamtab.operators.eventtime import with_event_time
from streamtab.operators.windows import slide
from streamtab.streaming.panes import block_windows, closed_windows
from streamtab.streaming.run import drain
from tests.conftest import rows
from tests.test_disorder import feed

AGGS = {"c": ("count", "*"), "f": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "mean": ("avg", "v")}


@given(st.lists(st.integers(-9, 9), min_size=1, max_size=40), st.integers(1, 12))
def test_block_scans_fold_every_window(values, m):
    values = np.array((values * m)[: max(len(values), m)])
    for fold, empty in ((np.add, 0), (np.minimum, 99), (np.maximum, -99)):
        want = [int(fold.reduce(values[i : i + m])) for i in range(len(values) - m + 1)]
        assert block_windows(values, m, fold, empty).tolist() == want


@settings(max_examples=200, deadline=None)
@given(
    st.dictionaries(st.integers(-30, 90), st.tuples(st.integers(0, 9), st.floats(-5, 5, width=16)), max_size=15),
    st.integers(1, 10), st.integers(1, 4), st.integers(-40, 60), st.integers(-40, 110),
)
def test_closed_windows_are_those_of_a_plain_loop(panes, m, s, after, upto):
    places = np.array(sorted(panes), np.int64)
    parts = {"_n_count": np.array([panes[p][0] for p in sorted(panes)], np.int64), "_v_min": np.array([panes[p][1] for p in sorted(panes)], float)}
    ends, totals = closed_windows(places, parts, m, s, after, upto)
    want = {}
    for e in range(after + 1, upto + 1):
        inside = [panes[p] for p in panes if e - m < p <= e]
        if inside and (e + 1 - m) % s == 0:
            want[e] = (sum(n for n, _ in inside), min(v for _, v in inside))
    assert dict(zip(ends.tolist(), zip(totals["_n_count"].tolist(), totals["_v_min"].tolist()))) == want


BATCHES = [
    [(1, 1, 1000, 4), (1, 2, 1020, None), (None, 3, 1007, 5)],
    [(1, 4, 1002, 7), (2, 5, 990, None), (2, 6, 1050, 2)],
    [(1, 7, 1100, 1), (1, 8, 1300, 9), (2, 9, 1299, None)],
    [(3, 10, 1290, 3), (1, 11, 2000, 6)],
    [(9, 99, 90_000, 0)],
]


@pytest.mark.parametrize("shape", [("60 seconds", "5 seconds"), ("50 seconds", "20 seconds"), ("7 seconds", "7 seconds")])
@pytest.mark.parametrize("keys", [["k"], []])
def test_stream_equals_batch_under_disorder(spark, tmp_path, keys, shape):
    stream = feed(spark, tmp_path, BATCHES).withColumn("v", F.col("side").cast("double")).where("ts < timestamp'1970-01-02'")
    got = rows(drain(slide(stream, "ts", *shape, keys, AGGS, "panes"), "panes"))
    flat = [(k, i, dt.datetime.fromtimestamp(s, dt.UTC), v) for batch in BATCHES[:-1] for k, i, s, v in batch]
    batch = spark.createDataFrame(flat, "k bigint, event_id bigint, ts timestamp, side int").withColumn("v", F.col("side").cast("double"))
    assert got == rows(slide(batch, "ts", *shape, keys, AGGS, "expand"))
    assert slide(stream, "ts", *shape, keys, AGGS, "panes").dtypes == slide(batch, "ts", *shape, keys, AGGS, "expand").dtypes


def test_a_key_holds_one_window_of_panes(spark, tmp_path):
    """Each batch moves the watermark on, and a pane leaves the state when its last window has closed."""
    from streamtab.streaming import panes

    held = []

    class Spy(panes._Ring):
        def __init__(self):
            super().__init__(["_rows"], [True], 4, 1, 1_000_000, [])
            self.state = None

        def _load(self):
            return self.state or (np.empty(0, np.int64), {"_rows": np.empty(0, np.int64)}, None, None)

        def _store(self, places, parts, done, armed):
            self.state = (places, parts, done, armed)
            held.append(len(places))

    class At:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):
            return self.ms

    import pandas as pd

    ring, out = Spy(), []
    for second in range(0, 100, 2):
        list(ring.handleInputRows((), iter([pd.DataFrame({"place": [second, second + 1], "p_rows": [1, 1]})]), None))
        ring.columns = ["_pos", "_rows"]
        out += [r for f in ring.handleExpiredTimer((), At(1000 * (second + 2)), None) for r in zip(f["_pos"], f["_rows"])]
    assert max(held) <= 4 + 2 and out == [(p, min(p + 1, 4)) for p in range(100)]


def test_slide_picks_panes_for_long_windows(spark, tmp_path):
    stream = with_event_time(spark.readStream.format("rate").load().withColumnRenamed("timestamp", "ts"), "ts", "1 minute")
    plan = slide(stream, "ts", "1 hour", "5 seconds", [], {"c": ("count", "*")})._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" in plan and "Expand" not in plan
