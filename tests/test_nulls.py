"""Null keys, groups without values, characters outside the basic plane, large cuts."""

from pyspark.sql import functions as F

from streamtab.functions import udfs
from streamtab.functions.text import hash_code, string_hash
from streamtab.operators.combine import match_two
from streamtab.operators.over import top_n


def utf16_hash(text):
    data, total = text.encode("utf-16-be"), 0
    for i in range(0, len(data), 2):
        total = (total * 31 + int.from_bytes(data[i : i + 2], "big")) & 0xFFFFFFFF
    return total - (1 << 32) if total >= 1 << 31 else total


def test_match_two_keeps_rows_with_null_keys(spark):
    left = spark.createDataFrame([(None, 1), (1, 10), (2, 50)], "k int, l int").selectExpr("k", "timestamp_seconds(l) AS l_ts")
    right = spark.createDataFrame([(None, 2), (1, 12)], "k int, r int").selectExpr("k", "timestamp_seconds(r) AS r_ts")
    got = match_two(left, right, ["k"], "l_ts", "r_ts", "5 seconds", "3 seconds")
    rows = sorted(((r["k"], r["status"]) for r in got.collect()), key=repr)
    assert rows == [(1, "matched"), (2, "left_only"), (None, "left_only"), (None, "right_only")]


def test_average_of_nothing_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), (None, 4.0)], "k string, v double")
    assert {r["k"]: r["m"] for r in udfs.average(df, "k", "v", "m").collect()} == {"a": 1.0, "b": None, None: 4.0}
    udfs.register(spark)
    df.createOrReplaceTempView("averaged")
    assert {r[0]: r[1] for r in spark.sql("SELECT k, avg_temp(v) FROM averaged GROUP BY k").collect()} == {"a": 1.0, "b": None, None: 4.0}


def test_string_hash_is_over_utf16_units(spark):
    texts = ["", "sensor_1", "héllo", "\U0001F600", "a\U0001F600b￿", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    want = [None if t is None else utf16_hash(t) for t in texts]
    assert [r[0] for r in df.select(string_hash(F.col("s"))).collect()] == want
    assert want[3] == 1772899
    udfs.register(spark)
    df.createOrReplaceTempView("hashed")
    assert [r[0] for r in spark.sql("SELECT hash_code(s, 23) FROM hashed").collect()] == [w if w is None else w * 23 for w in want]
    assert [r[0] for r in df.select(hash_code(F.col("s"))).collect()] == [w if w is None else w * 23 for w in want]


def test_large_cuts_are_spread(spark):
    df = spark.range(5000).selectExpr("1 AS part", "id * 7919 % 5000 AS v")
    got = top_n(df, ["part"], [F.col("v").desc()], 1001)
    assert [r["v"] for r in got.orderBy("rank").collect()] == list(range(4999, 3998, -1))
    assert "_piece" in got._jdf.queryExecution().toString() and got.columns == ["part", "v", "rank"]
