"""Streams that a caller starts with a sink and checkpoint of their own, stops and starts again."""

import datetime as dt

from pyspark.sql import functions as F

from streamtab.catalog.base import child_session
from streamtab.operators.eventtime import with_event_time
from streamtab.operators.over import top_n
from streamtab.operators.windows import slide
from streamtab.streaming import jobs
from streamtab.streaming.run import read_batches, start_rows
from streamtab.streaming.stateful import RunningCount, keyed_process
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
SCHEMA = "url string, method string, ts timestamp, event_id bigint"


def visits(first, last):
    """Three requests every ten seconds; later pages more often."""
    return [(f"/p{i * i % 5}", "GET" if i % 7 else "POST", T0 + dt.timedelta(seconds=i * 10 // 3), i) for i in range(first, last)]


def deliver(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def live(session, folder):
    return with_event_time(session.readStream.schema(SCHEMA).parquet(folder), "ts", "30 seconds")


PARTS = [(0, 150), (150, 170), (170, 400)]
CLOSING = [("/none", "GET", T0 + dt.timedelta(days=1), 10**6)]


def test_hot_pages_go_on_from_their_checkpoint(spark, tmp_path):
    folder, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    session = child_session(spark)
    for part in [*[visits(*p) for p in PARTS], CLOSING]:
        deliver(spark, folder, part)
        query = jobs.start_hot_pages(live(session, folder), path, state, n=2, size="1 minute", step="5 seconds", availableNow=True)
        query.awaitTermination()
    every = spark.createDataFrame(visits(0, 400), SCHEMA).where("method = 'GET'")
    want = top_n(slide(every, "ts", "1 minute", "5 seconds", ["url"], {"cnt": ("count", "*")}), ["window_end"], [F.col("cnt").desc(), F.col("url")], 2)
    got, wanted = (set(rows(df, "window_end", "url", "cnt", "rank")) for df in (read_batches(session, path).where("url <> '/none'"), want))
    assert got == wanted


def test_a_batch_that_failed_runs_again(spark, tmp_path):
    """The first batch that emits, number 1, breaks after its folder was written; the restarted query overwrites it."""
    folder, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    session = child_session(spark)
    deliver(spark, folder, visits(0, 300))
    deliver(spark, folder, CLOSING)
    real, calls = jobs._best, []

    def breaks(key, n):
        def each(batch):
            out = real(key, n)(batch)
            if not calls and not out.isEmpty():
                calls.append(1)
                out.write.mode("overwrite").parquet(f"{path}/batch=1")
                raise RuntimeError("lost")
            return out

        return each

    jobs._best = breaks
    try:
        for _ in range(2):
            query = jobs.start_hot_items(live(session, folder), "url", path, state, 2, "1 minute", "20 seconds", availableNow=True)
            try:
                query.awaitTermination()
            except Exception as error:  # noqa: BLE001
                assert "lost" in str(error)
    finally:
        jobs._best = real
    assert calls
    every = spark.createDataFrame(visits(0, 300), SCHEMA)
    want = top_n(slide(every, "ts", "1 minute", "20 seconds", ["url"], {"cnt": ("count", "*")}), ["window_end"], [F.col("cnt").desc(), F.col("url")], 2)
    got = read_batches(session, path).where("url <> '/none'").drop("batch")
    assert rows(got, *want.columns) == rows(want)


def test_counts_go_on_and_a_row_without_time_is_left_out(spark, tmp_path):
    folder, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    session = child_session(spark)
    for part in [*[visits(*p) for p in PARTS], [("/p1", "GET", None, -1)], CLOSING]:
        deliver(spark, folder, part)
        counts = keyed_process(live(session, folder), ["url"], ["ts", "event_id"], RunningCount(), "url string, event_id bigint, seq bigint")
        start_rows(counts, path, state, availableNow=True).awaitTermination()
    seen, want = {}, []
    for url, _, _, i in visits(0, 400):
        seen[url] = seen.get(url, 0) + 1
        want.append((url, i, seen[url]))
    assert rows(session.read.parquet(path).where("url <> '/none'"), "url", "event_id", "seq") == sorted(want, key=repr)
