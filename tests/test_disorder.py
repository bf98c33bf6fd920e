"""Keyed processors on streams whose rows come out of order over several batches."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from streamtab.catalog.base import child_session
from streamtab.operators.eventtime import with_event_time
from streamtab.streaming.run import drain, start_rows, use_rocksdb
from streamtab.streaming.stateful import KeyedProcessor, RunningCount, SlotMatcher, keyed_process

SCHEMA = "k bigint, event_id bigint, s bigint, side int"


def feed(spark, path, batches):
    """One file per batch, in order; times are seconds."""
    for i, rows in enumerate(batches):
        frame = pd.DataFrame(rows, columns=["k", "event_id", "s", "side"])
        spark.createDataFrame(frame, SCHEMA).coalesce(1).write.parquet(f"{path}/b{i}")
        name = next(f for f in os.listdir(f"{path}/b{i}") if f.startswith("part-"))
        os.makedirs(f"{path}/in", exist_ok=True)
        os.rename(f"{path}/b{i}/{name}", f"{path}/in/{i}.parquet")
        os.utime(f"{path}/in/{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    session = child_session(spark)
    use_rocksdb(session)
    stream = session.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    return with_event_time(stream.withColumn("ts", F.timestamp_seconds("s")), "ts", "60 seconds")


def test_match_waits_for_the_watermark(spark, tmp_path):
    batches = [[(1, 1, 1000, 0), (1, 2, 1020, 0)], [(1, 3, 1002, 1)], [(2, 4, 2000, 0)], [(2, 5, 3000, 0)]]
    schema = "k bigint, status string, l_ts timestamp_ntz, r_ts timestamp_ntz"
    out = keyed_process(feed(spark, tmp_path, batches), ["k"], ["ts", "event_id"], SlotMatcher("side", (5000, 3000)), schema)
    got = drain(out, "disorder").where("k = 1").collect()
    seconds = sorted((r["status"], r["l_ts"].timestamp() if r["l_ts"] else None) for r in got)
    assert [s for s, _ in seconds] == ["left_only", "matched"]
    assert seconds[0][1] - seconds[1][1] == 20


def test_rows_are_counted_in_time_order_and_late_ones_left_out(spark, tmp_path):
    batches = [[(1, 1, 1000, 0), (1, 2, 1050, 0)], [(1, 3, 1010, 0)], [(1, 4, 2000, 0)], [(2, 5, 2001, 0)], [(1, 6, 1005, 0)], [(2, 7, 5000, 0)]]
    out = keyed_process(feed(spark, tmp_path, batches), ["k"], ["ts", "event_id"], RunningCount(), "k bigint, event_id bigint, seq bigint")
    got = sorted((r["seq"], r["event_id"]) for r in drain(out, "counted").where("k = 1").collect())
    assert got == [(1, 1), (2, 3), (3, 2), (4, 4)]


def test_an_idle_key_is_forgotten(spark, tmp_path):
    batches = [[(1, 1, 1000, 0), (1, 2, 1050, 0)], [(2, 3, 4000, 0)], [(1, 4, 6000, 0)], [(2, 5, 9000, 0)]]
    out = keyed_process(feed(spark, tmp_path, batches), ["k"], ["ts", "event_id"], RunningCount(), "k bigint, event_id bigint, seq bigint", forget_ms=600_000)
    got = sorted((r["event_id"], r["seq"]) for r in drain(out, "forgotten").collect() if r["k"] == 1)
    assert got == [(1, 1), (2, 2), (4, 1)]


class Echo(KeyedProcessor):
    def on_row(self, row, state, timers):
        yield (int(row["event_id"]),)


@pytest.mark.parametrize("big", [2**53 + 1, 2**62 + 3])
def test_batch_keeps_long_keys_beside_null_ones(spark, big):
    df = spark.createDataFrame([(None, 1, 10, 0), (big, 2, 11, 0), (big + 1, 3, 12, 0)], SCHEMA).withColumn("ts", F.timestamp_seconds("s"))
    got = keyed_process(df.coalesce(1), ["k"], ["ts", "event_id"], Echo(), "k bigint, event_id bigint").collect()
    assert sorted(((r["event_id"], r["k"]) for r in got)) == [(1, None), (2, big), (3, big + 1)]


def test_many_keys_share_few_groups_of_state(spark, tmp_path):
    keys = [None, 2**53 + 1, 2**53 + 2, 2**62 + 3, *range(1, 400)]
    batches = [[(k, 10 * i + b, 1000 + 100 * b + (7 * i) % 90, 0) for i, k in enumerate(keys)] for b in range(3)] + [[(1, 9999, 9000, 0)]]
    for rows in batches:
        rows.reverse()
    schema = "k bigint, event_id bigint, seq bigint"
    # Objects keep whole numbers beside nulls whole on the way into the test's files.
    objects = [[tuple(map(lambda v: pd.NA if v is None else v, r)) for r in rows] for rows in batches]
    session_rows = feed_whole(spark, tmp_path, objects)
    out = keyed_process(session_rows, ["k"], ["ts", "event_id"], RunningCount(), schema, buckets=8)
    query = start_rows(out, f"{tmp_path}/rows", f"{tmp_path}/state", availableNow=True)
    query.awaitTermination()
    # A bucket holds its wake-up, a timer in two forms, and its rows and states in a few parts.
    assert all(p["stateOperators"][0]["numRowsTotal"] <= 8 * 8 for p in query.recentProgress if p["stateOperators"])
    got = sorted(((r["event_id"], r["k"], r["seq"]) for r in spark.read.schema(schema).parquet(f"{tmp_path}/rows").collect() if r["event_id"] != 9999))
    assert got == sorted((10 * i + b, k, b + 1) for i, k in enumerate(keys) for b in range(3))


def feed_whole(spark, path, batches):
    return feed(spark, path, [pd.DataFrame(rows, columns=["k", "event_id", "s", "side"]).astype({"k": "Int64"}) for rows in batches])
