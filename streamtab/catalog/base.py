"""Registration of queries and of the SQL each is checked against, and the table views they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from streamtab.functions.times import epoch_us
from streamtab.schemas import EVENTS
from streamtab.session import scratch_path
from streamtab.sources.files import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# `events` with the JSON property as a column.
EV = (
    "ev AS (SELECT event_id, ts, user_id, event_type, value, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"
)
# Every event with the 5-minute-stepped end of each 1-hour window that covers it.
HOPS = (
    "hops AS (SELECT ev.*, time_bucket(INTERVAL '5 minutes', ts) + (i * INTERVAL '5 minutes') AS window_end "
    "FROM ev, (SELECT unnest(generate_series(1, 12)) AS i))"
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain_times(fn(spark, folder))

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn

    return add


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone in results."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def _typed(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def ev(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(table(spark, folder, "events"))


def child_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's, for streams: their settings stay there."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.sparkContext.master.startswith("local["):
        # One state store per core is enough on one machine; a cluster keeps its own setting.
        session.conf.set("spark.sql.shuffle.partitions", str(min(8, spark.sparkContext.defaultParallelism)))
    return session


# How far behind the last event the row lies that closes a drained stream.
CLOSING_US = 7 * 86_400_000_000


def ev_stream(spark: SparkSession, folder: str, disorder: int = 0, batches: int = 4, closed: bool = False) -> DataFrame:
    """Events as a stream of `batches` micro-batches in order of arrival, time as an instant, no watermark yet.

    An event arrives up to `disorder` seconds after its time, by its id, so times are out of order within and between batches. With `closed` one
    more batch brings rows a week after the last event, which have a null `event_id`: the watermark then passes every event.
    """
    session = child_session(spark)
    rows = table(session, folder, "events")
    late = F.pmod(F.col("event_id") * 7919, F.lit(disorder)) * 1_000_000 if disorder else F.lit(0)
    rows = rows.withColumn("_at", epoch_us("ts") + late)
    rows = rows.persist()
    low, high = rows.agg(F.min("_at"), F.max("_at")).first()
    path = scratch_path(session, "arrivals")
    width = ((high or 0) - (low or 0)) // batches + 1
    files = rows.rdd.getNumPartitions()
    for i in range(batches):
        part = F.coalesce(F.floor((F.col("_at") - (low or 0)) / width), F.lit(0)) == i
        # Rows are dealt evenly, so that every batch has as many files as a trigger takes.
        rows.where(part).drop("_at").repartition(files).write.mode("append").parquet(path)
    if closed:
        # One row of every type, so that a filter on the type keeps one.
        end = F.timestamp_micros(F.lit((high or 0) + CLOSING_US)).cast("timestamp_ntz")
        last = rows.drop("_at").dropDuplicates(["event_type"]).withColumns({"event_id": F.lit(None).cast("bigint"), "ts": end})
        last.coalesce(1).write.mode("append").parquet(path)
    rows.unpersist()
    stream = session.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(path)
    return _typed(stream).withColumn("ts", F.col("ts").cast("timestamp"))
