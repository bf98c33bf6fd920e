"""The chunked way must equal the plain window on any data, chunk size and key skew."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from streamtab.operators.scan import frame, lag, lead, number_rows, run_count, run_first, run_max, run_min, run_over, run_sum
from tests.conftest import rows


def cols():
    return {
        "n": run_count(),
        "total": run_sum(F.col("v")),
        "rest": run_sum(F.col("v"), backward=True),
        "hi": run_max(F.col("v")),
        "later_lo": run_min(F.col("v"), backward=True),
        "first_id": run_first(F.col("id")),
        "last_v": run_first(F.col("v"), backward=True),
        "two_back": lag("v", 2),
        "ahead": lead("id", 1),
        "mean": frame(F.avg("v"), 3),
    }


few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
tables = st.lists(
    st.tuples(st.sampled_from(["a", "a", "a", "b", "c", None]), st.integers(0, 9), st.one_of(st.none(), st.integers(-5, 5))),
    min_size=1,
    max_size=60,
)


def frame_of(spark, data):
    return spark.createDataFrame([(k, t, v, i) for i, (k, t, v) in enumerate(data)], "k string, t int, v int, id int")


@few
@given(data=tables, hot=st.integers(1, 20), chunk=st.integers(3, 9))
def test_hot_keys_equal_plain(spark, data, hot, chunk):
    df = frame_of(spark, data)
    plain = run_over(df, ["k"], ["t", "id"], cols(), hot_rows=10_000)
    assert rows(run_over(df, ["k"], ["t", "id"], cols(), hot_rows=hot, chunk_rows=chunk)) == rows(plain)


@few
@given(data=tables, chunk=st.integers(3, 9))
def test_whole_table_equals_one_key(spark, data, chunk):
    df = frame_of(spark, data)
    plain = run_over(df.withColumn("one", F.lit(1)), ["one"], ["t", "id"], cols(), hot_rows=10_000).drop("one")
    assert rows(run_over(df, [], ["t", "id"], cols(), chunk_rows=chunk)) == rows(plain)


def test_number_rows_has_no_single_partition_window(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("t"), "id")
    got = number_rows(df, [], ["t", "id"])
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("t", "id")).cast("bigint"))
    assert rows(got, "id", "rn") == rows(want, "id", "rn")


def test_hot_keys_are_broadcast_before_any_shuffle(spark):
    """No exchange on the key may stand under the joins that part hot keys from the rest, whatever Spark's own threshold."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(3000).selectExpr("CASE WHEN id % 10 < 8 THEN 'hot' ELSE CAST(id AS STRING) END AS k", "id", "id % 7 AS v")
        out = run_over(df, ["k"], ["id"], {"n": run_count(), "hi": run_max(F.col("v"))}, hot_rows=1000, chunk_rows=200)
        plan = out._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" in plan and "LeftAnti, BuildRight" in plan
        got = {(r["id"], r["n"], r["hi"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    up = Window.partitionBy("k").orderBy("id")
    want = {(r["id"], r["n"], r["hi"]) for r in df.select("id", F.row_number().over(up).alias("n"), F.max("v").over(up).alias("hi")).collect()}
    assert got == want
