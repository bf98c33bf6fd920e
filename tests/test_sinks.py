"""Sinks are replay-safe; Spark refuses what it must."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from streamtab.sources import broker, sinks
from streamtab.sources.parse import parse_change_event
from tests.conftest import rows


def batch(spark, data):
    return spark.createDataFrame(data, "k bigint, v string, seq bigint")


def test_upsert_jdbc_on_in_process_database(spark):
    """Derby in memory inside this one JVM; on a cluster the URL names a real database."""
    url = "jdbc:derby:memory:upsert;create=true"
    read = lambda: spark.read.jdbc(url, "target")
    batch(spark, [(1, "a", 1), (2, "b", 1)]).write.jdbc(url, "target")
    change = batch(spark, [(2, "c", 3), (2, "x", 2), (3, "d", 1)])
    for _ in range(2):
        sinks.upsert_jdbc(change, url, "target", "staged", ["k"], ["seq"])
        assert rows(read(), "k", "v") == [(1, "a"), (2, "c"), (3, "d")]


def test_upsert_table_replay_and_compact(spark, tmp_path):
    path, order = str(tmp_path / "t"), ["seq"]
    sinks.upsert_table(batch(spark, [(1, "a", 1), (2, "b", 1)]), path, ["k"], order, 0)
    for _ in range(2):
        sinks.upsert_table(batch(spark, [(1, "c", 2), (1, "late", 0)]), path, ["k"], order, 1)
    want = [(1, "c"), (2, "b")]
    assert rows(sinks.read_latest(spark, path, ["k"], order), "k", "v") == want
    sinks.compact(spark, path, str(tmp_path / "c"), ["k"], order)
    assert rows(sinks.read_latest(spark, str(tmp_path / "c"), ["k"], order), "k", "v") == want


def test_csv_append_refuses_updating_aggregate(spark, tmp_path):
    src = str(tmp_path / "in")
    batch(spark, [(1, "a", 1)]).write.parquet(src)
    live = spark.readStream.schema("k bigint, v string, seq bigint").parquet(src)
    with pytest.raises(AnalysisException):
        sinks.append_csv(live.groupBy("k").count(), str(tmp_path / "out"), str(tmp_path / "cp"))
    query = sinks.append_csv(live.where("k = 1"), str(tmp_path / "ok"), str(tmp_path / "cp2"))
    query.processAllAvailable()
    query.stop()
    assert spark.read.csv(str(tmp_path / "ok")).count() == 1


def test_tagged_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    batch(spark, [(1, "a", 1), (2, "b", 1)]).write.parquet(src)
    live = spark.readStream.schema("k bigint, v string, seq bigint").parquet(src)
    tagged = live.withColumn("tag", F.when(F.col("k") > 1, "high").otherwise("low"))
    out = str(tmp_path / "out")
    sinks.write_tagged_stream(tagged, out, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(out), "k", "tag") == [(1, "low"), (2, "high")]


def test_broker_round_trip(spark):
    out = broker.to_broker_value(batch(spark, [(1, "a", 7)]), ["k", "v", "seq"])
    assert rows(broker.decode(out, "k bigint, v string, seq bigint")) == [(1, "a", 7)]


def test_change_event_missing_image_is_empty(spark):
    raw = spark.createDataFrame([("m.shop.t", None, '{"id": 1}', "CREATE")], "topic string, before string, after string, op string")
    got = parse_change_event(raw, "id bigint").first()
    assert got["db"] == "shop" and got["table_name"] == "t" and got["op"] == "create"
    assert got["before"] is not None and got["before"]["id"] is None and got["after"]["id"] == 1


def test_a_replayed_write_takes_the_place_of_the_first(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k bigint, v string, seq bigint"
    sinks.append_csv(batch(spark, [(1, "a", 1)]), path, write_id="x")
    for _ in range(2):
        sinks.append_csv(batch(spark, [(2, "b", 1), (2, "b", 1)]), path, write_id="y")
    # A write that died before its entry is not seen.
    batch(spark, [(9, "z", 9)]).write.csv(f"{path}/rows/left-behind")
    assert rows(sinks.read_written(spark, path, schema, "csv"), "k", "v") == [(1, "a"), (2, "b"), (2, "b")]


def test_tags_go_to_sinks_of_their_own(spark, tmp_path):
    places = {"1": ("csv", str(tmp_path / "a")), "2": ("json", str(tmp_path / "b"))}
    df = batch(spark, [(1, "a", 1), (2, "b", 1), (1, "c", 3)]).withColumn("tag", F.col("k").cast("string"))
    for _ in range(2):
        sinks.write_tags(df, places, 0)
    got = [rows(sinks.read_written(spark, place, "k bigint, v string, seq bigint", fmt), "v", "seq") for fmt, place in places.values()]
    assert got == [[("a", 1), ("c", 3)], [("b", 1)]]
    with pytest.raises(ValueError):
        sinks.write_tags(df.withColumn("tag", F.lit(None).cast("string")), places, 1)


def test_tagged_stream_survives_a_restart(spark, tmp_path):
    """Stopped after each run and started again from its checkpoint, it writes every row once."""
    places, schema = {"1": ("csv", str(tmp_path / "a")), "2": ("parquet", str(tmp_path / "b"))}, "k bigint, v string, seq bigint"
    for i, data in enumerate([[(1, "a", 1), (2, "b", 2)], [(1, "c", 3)]]):
        batch(spark, data).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in")).withColumn("tag", F.col("k").cast("string"))
        sinks.write_tags_stream(stream, places, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = [rows(sinks.read_written(spark, place, schema, fmt), "v", "seq") for fmt, place in places.values()]
    assert got == [[("a", 1), ("c", 3)], [("b", 2)]]
