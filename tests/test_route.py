"""Routing, distribution and per-partition resources."""

from pyspark.sql import functions as F

from streamtab.operators import route
from streamtab.sources import files
from tests.conftest import rows


def parts(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().count()


def test_distribution_kinds(spark):
    df = spark.range(0, 400, 1, 5)
    high = F.when(F.col("id") > 30, 0).otherwise(1)
    for how, n in (("random", 4), ("round_robin", 4), ("rescale", 2), ("single", 1)):
        placed = route.distribute(df, how, n)
        assert placed.count() == 400 and parts(placed) == n
    assert parts(route.distribute(df, "forward", 0)) == 5
    custom = route.distribute(df, "custom", 2, high)
    assert custom.where(F.spark_partition_id() != high).count() == 0


def test_broadcast_only_below_its_bound(spark, capsys):
    big, small = spark.range(1000), spark.range(10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bound, expected in ((10, True), (9, False)):
            big.join(route.distribute(small, "broadcast", bound), "id").explain()
            assert ("BroadcastHashJoin" in capsys.readouterr().out) is expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_routes_overlap_by_first_rule_and_default(spark):
    df = spark.range(10)
    out = route.route(df, {"big": F.col("id") > 6, "odd": F.col("id") % 2 == 1}, default="rest")
    assert [sorted(r[0] for r in out[t].collect()) for t in ("big", "odd", "rest")] == [[7, 8, 9], [1, 3, 5], [0, 2, 4, 6]]
    only = route.route(df, {"big": F.col("id") > 6})
    assert list(only) == ["big"]


def test_partition_resource_opens_and_closes_once(spark, tmp_path):
    log = str(tmp_path / "log")

    def open_():
        with open(log, "a") as f:
            f.write("o")
        return 10

    def close(_):
        with open(log, "a") as f:
            f.write("c")

    out = route.map_partitions(spark.range(0, 9, 1, 3), open_, lambda add, b: b + add, close, "id bigint")
    assert rows(out) == sorted([(i + 10,) for i in range(9)], key=repr)
    assert sorted(open(log).read()) == list("cccooo")


def test_text_stream_and_literal_rows(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x y\n\nz\n")
    live = files.read_lines(spark, str(tmp_path), stream=True)
    assert live.isStreaming and rows(files.read_lines(spark, str(tmp_path))) == [("",), ("x y",), ("z",)]
    assert rows(files.from_rows(spark, [("a", 1)], "k string, v int")) == [("a", 1)]
