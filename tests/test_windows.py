"""Scale forms against their simple forms, on random tables."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamtab.functions.text import bitmap_slot, hash_code, split_parts
from streamtab.functions.times import micros
from streamtab.operators import aggregate, combine, windows
from streamtab.streaming.run import drain
from tests.conftest import rows

few = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = dt.datetime(2024, 1, 1)
seconds = st.integers(0, 4000)


def events(spark, data):
    return spark.createDataFrame(
        [(k, T0 + dt.timedelta(seconds=s), float(v), i) for i, (k, s, v) in enumerate(data)],
        "k string, ts timestamp_ntz, v double, id int",
    )


tables = st.lists(st.tuples(st.sampled_from(["a", "a", "b"]), seconds, st.integers(0, 9)), min_size=1, max_size=40)


@few
@given(data=tables, shape=st.sampled_from([("60 seconds", "10 seconds"), ("90 seconds", "25 seconds"), ("5 minutes", "5 minutes")]))
def test_panes_equal_expansion(spark, data, shape):
    df = events(spark, data)
    for keys in (["k"], []):
        for aggs in (
            {"c": ("count", "*")},
            {"c": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "m": ("avg", "v")},
        ):
            simple = windows.slide(df, "ts", *shape, keys, aggs, "expand")
            assert rows(windows.slide(df, "ts", *shape, keys, aggs, "panes")) == rows(simple)


def test_panes_across_stretch_edges(spark):
    df = spark.range(0, 4000, 3).select(F.timestamp_seconds(F.col("id") * 7).cast("timestamp_ntz").alias("ts"), "id")
    simple = windows.slide(df, "ts", "1 minute", "10 seconds", [], {"c": ("count", "*")}, "expand")
    assert rows(windows.slide(df, "ts", "1 minute", "10 seconds", [], {"c": ("count", "*")}, "panes")) == rows(simple)


@few
@given(data=tables)
def test_salted_and_split_equal_plain(spark, data):
    df = events(spark, data)
    plain = windows.tumble(df, "ts", "10 minutes", ["k"], {"cnt": F.count("*")}).drop("window_start")
    assert rows(aggregate.salted_window_count(df, "ts", ["k"], "10 minutes", "id")) == rows(plain)
    distinct = df.groupBy("k").agg(F.count_distinct("v").alias("cnt"))
    assert rows(aggregate.split_count_distinct(df, ["k"], "v", 7)) == rows(distinct)


@few
@given(left=tables, right=tables, low=st.integers(-400, 100), length=st.integers(0, 600))
def test_bucketed_join_and_unmatched_equal_nested_loop(spark, left, right, low, length):
    lo, hi = f"{low} seconds" if low >= 0 else f"-{-low} seconds", low + length
    hi = f"{hi} seconds" if hi >= 0 else f"-{-hi} seconds"
    a = events(spark, left).select("k", F.col("ts").alias("lt"), F.col("id").alias("li"))
    b = events(spark, right).select("k", F.col("ts").alias("rt"), F.col("id").alias("ri"))
    pairs, lone_l, lone_r = [], [], []
    for i, (k, s, _) in enumerate(left):
        hits = [j for j, (k2, s2, _) in enumerate(right) if k2 == k and low <= s2 - s <= low + length]
        pairs += [(i, j) for j in hits]
        lone_l += [] if hits else [i]
    matched = {j for _, j in pairs}
    lone_r = [j for j in range(len(right)) if j not in matched]
    assert rows(combine.interval_join(a, b, ["k"], "lt", "rt", lo, hi), "li", "ri") == sorted(pairs, key=repr)
    alone = combine.unmatched(a, b, ["k"], "lt", "rt", lo, hi)
    assert rows(alone.where("side = 0"), "row_left.li") == sorted([(i,) for i in lone_l], key=repr)
    assert rows(alone.where("side = 1"), "row_right.ri") == sorted([(j,) for j in lone_r], key=repr)


def test_approx_distinct_error(spark):
    df = spark.range(20_000).select(F.timestamp_seconds(F.lit(0)).alias("ts"), "id")
    got = windows.window_distinct(df, "ts", "1 hour", "id", approx=True).first()["uv"]
    assert abs(got - 20_000) < 20_000 * 0.15


def test_scalar_functions(spark):
    one = spark.range(1)
    first = lambda c: one.select(c.alias("x")).first()["x"]
    assert first(hash_code(F.lit("sensor_1"), 1)) == 1262115052
    h = 0
    for ch in "20231":
        h = h * 61 + ord(ch)
    assert first(bitmap_slot(F.lit(20231))) == h & ((1 << 29) - 1)
    assert first(split_parts(F.lit("a  b  "), " ")) == ["a", "", "b"]
    assert first(split_parts(F.lit("_a__"), "_")) == ["", "a"]
    assert first(split_parts(F.lit("  "), " ")) == []
    assert first(split_parts(F.lit(""), " ")) == [""]
    assert micros("1 hour 5 minutes") == 3_900_000_000 and micros("-2 seconds") == -2_000_000


def test_stream_equals_batch_for_closed_windows(spark, tmp_path):
    df = events(spark, [("a", s, s % 7) for s in range(0, 4000, 13)])
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")).withColumn("ts", F.col("ts").cast("timestamp"))
    live = live.withWatermark("ts", "10 seconds")
    aggs = {"c": F.count("*")}
    got = drain(windows.tumble(live, "ts", "5 minutes", ["k"], aggs), "t")
    end = df.agg(F.max("ts") - F.expr("INTERVAL 10 SECONDS")).first()[0]
    want = windows.tumble(df, "ts", "5 minutes", ["k"], aggs).where(F.col("window_end") <= F.lit(end))
    assert rows(got.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})) == rows(want)


@pytest.mark.parametrize("kind", ["sum", "avg", "min", "max", "count"])
@pytest.mark.parametrize("type_", ["int", "double", "decimal(10,2)"])
def test_both_slides_agree_in_type_and_value(spark, kind, type_):
    rows = [(i % 3, f"2024-01-01 00:{i % 60:02d}:{i * 7 % 60:02d}", None if i % 5 == 0 else i * 3 % 11) for i in range(80)] + [(9, "2024-01-01 00:00:00", None)]
    df = spark.createDataFrame(rows, "k int, ts string, v int").selectExpr("k", "CAST(ts AS TIMESTAMP) AS ts", f"CAST(v AS {type_}) AS v")
    one, two = (windows.slide(df, "ts", "10 minutes", "1 minute", ["k"], {"x": (kind, "v")}, s) for s in ("expand", "panes"))
    assert one.schema["x"].dataType == two.schema["x"].dataType
    assert listed(one) == listed(two)


def listed(df):
    return sorted((tuple(round(float(v), 5) if i == 2 and v is not None else v for i, v in enumerate(r)) for r in df.collect()), key=repr)
