"""Patterns, state processors and jobs on small fixtures, against brute force and known answers."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamtab.operators import combine, over, pattern
from streamtab.plans import jobs
from streamtab.sources.parse import parse_access_log, parse_delimited
from streamtab.streaming import stateful
from streamtab.streaming.run import drain
from streamtab import schemas
from tests.conftest import rows

few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = dt.datetime(2024, 1, 1)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def timeline(spark, data, kind="string"):
    """(key, second, value) rows with an id in time order."""
    data = sorted(data, key=lambda r: r[1])
    return spark.createDataFrame([(k, at(s), i, v) for i, (k, s, v) in enumerate(data)], f"k string, ts timestamp_ntz, event_id int, v {kind}")


def test_rolling_lists(spark):
    lines = ["sensor_1,1547718199,35.8", "sensor_6,1547718201,15.4", "sensor_1,1547718207,36.3", "", "bad",
             "sensor_1,1547718209,32.8", "sensor_1,1547718212,37.1"]
    df = parse_delimited(spark.createDataFrame([(x,) for x in lines], "line string"), schemas.SENSOR)
    assert df.count() == 5

    def run(kind):
        out = over.rolling(df, ["id"], ["timestamp"], kind, "temperature").where("id = 'sensor_1'").orderBy("seq")
        return [(r["timestamp"] - 1547718000, round(r["temperature"], 6)) for r in out.collect()]

    assert run("sum") == [(199, 35.8), (199, 72.1), (199, 104.9), (199, 142.0)]
    assert run("max") == [(199, 35.8), (199, 36.3), (199, 36.3), (199, 37.1)]
    assert run("max_by") == [(199, 35.8), (207, 36.3), (207, 36.3), (212, 37.1)]
    assert run("reduce") == [(199, 35.8), (207, 36.3), (209, 36.3), (212, 37.1)]


def brute_runs(data, member, width):
    """Timer simulation of anchored runs for one key: (start, last, n) of the runs that fire."""
    out, pending = [], None
    for s, v in data:
        if pending and s > pending[0] + width:
            out.append(tuple(pending))
            pending = None
        if member(v):
            if pending:
                pending[1], pending[2] = s, pending[2] + 1
            else:
                pending = [s, s, 1]
        else:
            pending = None
    return out + ([tuple(pending)] if pending else [])


@few
@given(data=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60), st.sampled_from("fffffs")), min_size=1, max_size=60, unique_by=lambda r: r[:2]))
def test_fail_burst_equals_timers(spark, data):
    df = timeline(spark, data)
    got = pattern.fail_burst(df, ["k"], ["ts", "event_id"], F.col("v") == "f", "4 seconds", 2)
    want = []
    for k in "ab":
        mine = sorted((s, v) for key, s, v in data if key == k)
        want += [(k, at(a), at(b), n) for a, b, n in brute_runs(mine, lambda v: v == "f", 4) if n >= 2]
    assert rows(got, "k", "start_ts", "last_ts", "n") == sorted(want, key=repr)
    machine = stateful.FailBurst("failed", 4000, 2)
    same = stateful.keyed_process(
        df.withColumn("failed", F.col("v") == "f"), ["k"], ["ts", "event_id"], machine,
        "k string, start_ts timestamp_ntz, last_ts timestamp_ntz, n bigint",
    )
    assert rows(same) == rows(got, "k", "start_ts", "last_ts", "n")


def test_long_island_chain_on_hot_key(spark):
    """One endless run of failures, with every key treated as hot."""
    spark.conf.set("streamtab.hotKeyRows", "20")
    spark.conf.set("streamtab.chunkRows", "16")
    try:
        data = [("a", s, "f") for s in range(0, 200)]
        got = pattern.fail_burst(timeline(spark, data), ["k"], ["ts", "event_id"], F.col("v") == "f", "4 seconds", 2)
        want = [("a", at(a), at(b), n) for a, b, n in brute_runs([(s, "f") for s in range(200)], lambda v: True, 4)]
        assert rows(got, "k", "start_ts", "last_ts", "n") == sorted(want, key=repr)
    finally:
        spark.conf.unset("streamtab.hotKeyRows")
        spark.conf.unset("streamtab.chunkRows")


@few
@given(data=st.lists(st.tuples(st.just("a"), st.integers(0, 80), st.integers(0, 30)), min_size=1, max_size=50, unique_by=lambda r: r[1]))
def test_rising_alert_equals_processor(spark, data):
    df = timeline(spark, data, "int")
    got = pattern.rising_alert(df, ["k"], ["ts", "event_id"], "v", "5 seconds")
    same = stateful.keyed_process(
        df, ["k"], ["ts", "event_id"], stateful.RisingAlert("v", 5000), "k string, rise_ts timestamp_ntz, alert_ts timestamp_ntz"
    )
    assert rows(got) == rows(same)


def test_consecutive_overlap_and_strictness(spark):
    data = [("a", 0, "f"), ("a", 1, "f"), ("a", 2, "f"), ("a", 3, "s"), ("a", 4, "f"), ("a", 9, "f"), ("b", 5, "f"), ("b", 7, "f")]
    df, order, failed = timeline(spark, data), ["ts", "event_id"], F.col("v") == "f"
    pairs = pattern.consecutive(df, ["k"], order, failed, 2, "2 seconds")
    assert rows(pairs, "k", "first_ts", "last_ts") == [("a", at(0), at(1)), ("a", at(1), at(2)), ("b", at(5), at(7))]
    assert pattern.consecutive(df, ["k"], order, failed, 3, "2 seconds", inclusive=False).count() == 0
    assert pattern.consecutive(df, ["k"], order, failed, 3, "2 seconds").count() == 1


def test_click_cap_warns_once_a_day(spark):
    df = timeline(spark, [("a", i, "x") for i in range(7)] + [("a", 86400 + i, "x") for i in range(2)])
    passed, warned = pattern.cap_per_day(df, ["k", "v"], ["ts", "event_id"], 5)
    assert passed.count() == 7 and rows(warned, "k", "warning_msg") == [("a", "click over 5 times.")]
    zone_day, _ = pattern.cap_per_day(timeline(spark, [("a", 57599, "x"), ("a", 57600, "x")]), ["k"], ["ts"], 1, "Asia/Shanghai")
    assert zone_day.count() == 2


def test_order_outcomes_and_state_machine(spark):
    data = [("paid", 0, "create"), ("paid", 899, "pay"), ("late", 0, "create"), ("late", 900, "pay"), ("none", 0, "create"),
            ("stray", 5, "pay")]
    df = timeline(spark, data)
    got = pattern.first_outcome(df, "k", "ts", F.col("v") == "create", F.col("v") == "pay", "15 minutes")
    want = [("late", "paid_late"), ("none", "never_paid"), ("paid", "paid"), ("stray", "paid_without_create")]
    assert rows(got, "k", "result_state") == want
    # The machine runs on a watermark that passes the deadline with the late payment, so it has timed out by then.
    machine = stateful.OrderOutcome("v", "create", "pay", 900_000)
    out = stateful.keyed_process(df, ["k"], ["ts", "event_id"], machine, "k string, result_state string")
    assert rows(out) == want
    assert rows(pattern.order_outcome(df, ["k"], ["ts", "event_id"], F.col("v") == "create", F.col("v") == "pay", "15 minutes")) == sorted(
        [("late", "paid_late"), *[w for w in want if w[0] != "late"]]
    )


@pytest.mark.parametrize("seed,hot", [(1, None), (2, None), (3, 40)])
def test_order_outcomes_are_those_of_the_machine(spark, seed, hot):
    rng = random.Random(seed)
    times = {k: sorted(rng.randrange(60) for _ in range(n)) for k, n in (("a", 30), ("b", 60), ("c", 1), ("d", 200))}
    data = [(k, t, rng.choice(["create", "pay", "pay", "create", "other"])) for k, at in times.items() for t in at]
    df = timeline(spark, data)
    machine = stateful.OrderOutcome("v", "create", "pay", 3_000)
    want = rows(stateful.keyed_process(df, ["k"], ["ts", "event_id"], machine, "k string, result_state string"))
    if hot:
        spark.conf.set("streamtab.hotKeyRows", str(hot))
        spark.conf.set("streamtab.chunkRows", "16")
    try:
        got = rows(pattern.order_outcome(df, ["k"], ["ts", "event_id"], F.col("v") == "create", F.col("v") == "pay", "3 seconds"))
    finally:
        spark.conf.unset("streamtab.hotKeyRows")
        spark.conf.unset("streamtab.chunkRows")
    assert got == want and len({s for _, s in got}) == 4


def brute_slots(data, waits):
    """One pending slot per side, timers at wait after each pending event."""
    out, slot, timers = [], {}, []

    def fire(before):
        while timers and (before is None or min(timers) < before):
            timers.remove(min(timers))
            out.extend(("left_only", slot[0], None) if side == 0 else ("right_only", None, slot[1]) for side in sorted(slot))
            slot.clear()

    for s, side in data:
        fire(s)
        if 1 - side in slot:
            out.append(("matched", s if side == 0 else slot[0], s if side == 1 else slot[1]))
            slot.clear()
        else:
            slot[side] = s
            if s + waits[side] not in timers:
                timers.append(s + waits[side])
    fire(None)
    return out


@few
@given(data=st.lists(st.tuples(st.integers(0, 40), st.integers(0, 1)), min_size=1, max_size=30, unique_by=lambda r: r[0]))
def test_slot_matcher(spark, data):
    data = sorted(data)
    df = timeline(spark, [("a", s, side) for s, side in data], "int")
    schema = "k string, status string, l timestamp_ntz, r timestamp_ntz"
    got = stateful.keyed_process(df, ["k"], ["ts", "event_id"], stateful.SlotMatcher("v", (5000, 3000)), schema)
    want = [("a", st_, None if l is None else at(l), None if r is None else at(r)) for st_, l, r in brute_slots(data, (5, 3))]
    assert rows(got) == sorted(want, key=repr)
    split = stateful.keyed_process(df, ["k"], ["ts", "event_id"], stateful.SlotMatcher("v", (5000, 3000)), schema, 5000)
    assert rows(split) == rows(got)


def test_processor_on_stream_in_two_batches(spark, tmp_path):
    """State and timers survive from one micro-batch to the next."""
    data = [("a", s, v) for s, v in [(0, 1), (2, 3), (4, 4), (11, 9), (30, 2), (31, 5), (60, 1)]]
    df = timeline(spark, data, "int")
    df.where("event_id < 4").coalesce(1).write.parquet(str(tmp_path / "in"))
    df.where("event_id >= 4").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    live = live.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "0 seconds")
    schema = "k string, rise_ts timestamp_ntz, alert_ts timestamp_ntz"
    got = drain(stateful.keyed_process(live, ["k"], ["ts", "event_id"], stateful.RisingAlert("v", 5000), schema), "p")
    want = stateful.keyed_process(df, ["k"], ["ts", "event_id"], stateful.RisingAlert("v", 5000), schema)
    assert rows(got) == rows(want)


def test_stream_full_match(spark, tmp_path):
    left = spark.createDataFrame([("a", at(0), 1), ("b", at(10), 2), ("z", at(500), 9)], "k string, lt timestamp, li int")
    right = spark.createDataFrame([("a", at(4), 1), ("c", at(20), 3), ("z", at(500), 9)], "k string, rt timestamp, ri int")
    for name, df in (("l", left), ("r", right)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
    l = spark.readStream.schema(left.schema).parquet(str(tmp_path / "l")).withWatermark("lt", "0 seconds")
    r = spark.readStream.schema(right.schema).parquet(str(tmp_path / "r")).withWatermark("rt", "0 seconds")
    got = drain(combine.match_two(l, r, ["k"], "lt", "rt", "5 seconds", "3 seconds"), "m")
    assert {("a", "matched"), ("b", "left_only"), ("c", "right_only"), ("z", "matched")} == set(rows(got, "k", "status"))


def test_access_log_and_hot_pages(spark):
    lines = ["1.1.1.1 - - 17/05/2015:10:05:03 +0000 GET /a", "1.1.1.1 - - 17/05/2015:10:05:04 +0000 GET /a.css",
             "1.1.1.1 - - 17/05/2015:10:05:05 +0000 POST /a", "", "1.1.1.1 - - 17/05/2015:10:05:06 +0000 GET /b",
             "1.1.1.1 - - 17/05/2015:10:05:07 +0000 GET /b"]
    log = parse_access_log(spark.createDataFrame([(x,) for x in lines], "line string"))
    assert log.count() == 5
    top = jobs.hot_pages(log, n=1).where(F.col("window_end") == F.lit("2015-05-17 10:06:00").cast("timestamp"))
    assert [(r["url"], r["cnt"], r["rank"]) for r in top.collect()] == [("/b", 2, 1)]


def test_top2_keeps_repeats_and_drops_non_positive(spark):
    df = timeline(spark, [("a", 0, 5), ("a", 1, 5), ("a", 2, 3), ("b", 3, 0), ("c", 4, -1), ("c", 5, 2)], "int")
    assert rows(over.top_k_values(df, "k", "v")) == [("a", 5, 1), ("a", 5, 2), ("c", 2, 1)]
