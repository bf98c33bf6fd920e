"""Projection, filters, routing, joins and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamtab.catalog.base import EV, ev, query
from streamtab.functions import udfs
from streamtab.functions.text import hash_code
from streamtab.operators import combine, eventtime, route
from streamtab.operators.over import top_k_values
from streamtab.sources.files import table


@query("map_length", "SELECT doc_id, CAST(length(text) AS BIGINT) AS length FROM documents")
def map_length(spark, folder):
    return route.with_length(table(spark, folder, "documents").select("doc_id", "text"), "text").drop("text")


@query(
    "flat_map_split",
    """
    SELECT doc_id, unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents
    WHERE text = '' OR rtrim(text, ' ') <> ''
    """,
)
def flat_map_split(spark, folder):
    return route.explode_split(table(spark, folder, "documents").select("doc_id", "text"), "text", " ")


@query("filter_threshold", f"WITH {EV} SELECT * FROM ev WHERE value > 20.0")
def filter_threshold(spark, folder):
    return ev(spark, folder).where(F.col("value") > 20.0)


@query("select_where", "SELECT event_id, user_id, value FROM events WHERE event_type = 'view'")
def select_where(spark, folder):
    return route.select_where(ev(spark, folder), ["event_id", "user_id", "value"], F.col("event_type") == "view")


@query("select_where_sql", "SELECT event_id, user_id, value FROM events WHERE event_type = 'view'")
def select_where_sql(spark, folder):
    return route.select_where_sql(ev(spark, folder), ["event_id", "user_id", "value"], "event_type = 'view'")


@query(
    "filter_behaviour",
    f"""
    WITH {EV} SELECT event_id, 'view' AS kept_by FROM ev WHERE event_type = 'view'
    UNION ALL SELECT event_id, 'not_error' FROM ev WHERE event_type <> 'error'
    UNION ALL SELECT event_id, 'has_tx' FROM ev WHERE event_type = 'purchase'
    """,
)
def filter_behaviour(spark, folder):
    rows = ev(spark, folder)
    tx = F.when(F.col("event_type") == "purchase", F.col("k").cast("string"))
    rules = {
        "view": F.col("event_type") == "view",
        "not_error": F.col("event_type") != "error",
        "has_tx": F.coalesce(tx, F.lit("")) != "",
    }
    # One pass over the table: a row is repeated for each rule it meets.
    kept = F.explode(F.array_compact(F.array(*[F.when(p, F.lit(n)) for n, p in rules.items()])))
    return rows.select("event_id", kept.alias("kept_by"))


@query("filter_static_url", r"SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '\.(css|js|png|ico)$')")
def filter_static_url(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", F.lit("GET").alias("method"))
    return route.page_requests(pages).drop("method")


@query("rename_project", "SELECT CAST(user_id AS VARCHAR) AS id, value AS temperature, ts AS rt FROM events")
def rename_project(spark, folder):
    return route.with_schema(
        ev(spark, folder), {"id": F.col("user_id").cast("string"), "temperature": "value", "rt": "ts"}
    )


@query("partition_map", "SELECT event_id, user_id AS id, CAST(user_id % 4 AS INTEGER) AS subtask FROM events")
def partition_map(spark, folder):
    """The resource opened once per partition is the number of the partition, which a keyed distribution decides."""
    rows = route.distribute(ev(spark, folder).select("event_id", "user_id"), "custom", 4, F.pmod("user_id", F.lit(4)))

    def opened():
        from pyspark import TaskContext

        return TaskContext.get().partitionId()

    def add(subtask, batch):
        return batch.rename(columns={"user_id": "id"}).assign(subtask=subtask)

    return route.map_partitions(rows, opened, add, lambda subtask: None, "event_id bigint, id bigint, subtask int")


@query("processing_time", "SELECT count(*) AS n, CAST(1 AS BIGINT) AS instants, true AS after_events FROM events")
def processing_time(spark, folder):
    """One instant for a whole batch, later than the events."""
    rows = eventtime.with_processing_time(ev(spark, folder))
    return rows.agg(
        F.count("*").alias("n"), F.count_distinct("pt").alias("instants"), (F.min("pt") > F.max("ts").cast("timestamp")).alias("after_events")
    )


@query(
    "route_split",
    "SELECT event_id, value, CASE WHEN value > 30.0 THEN 'high' ELSE 'low' END AS tag FROM events",
)
def route_split(spark, folder):
    tagged = route.tag_rows(
        ev(spark, folder).select("event_id", "value"), {"high": F.col("value") > 30.0, "low": F.col("value") <= 30.0}
    )
    return route.pick(tagged, "high", "low")


@query(
    "route_side",
    """
    SELECT CASE WHEN value > 30.0 THEN 'main' ELSE 'low' END AS output, count(*) AS n, min(value) AS lo, max(value) AS hi
    FROM events GROUP BY 1
    """,
)
def route_side(spark, folder):
    outputs = route.route(ev(spark, folder), {"main": F.col("value") > 30.0}, default="low")
    stats = [F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")]
    return combine.union_all(*[df.groupBy(F.lit(name).alias("output")).agg(*stats) for name, df in outputs.items()])


@query("repartition_by", "SELECT event_id, value, CASE WHEN value > 30.0 THEN 0 ELSE 1 END AS part FROM events")
def repartition_by(spark, folder):
    rows = ev(spark, folder).select("event_id", "value")
    placed = route.distribute(rows, "custom", 2, F.when(F.col("value") > 30.0, 0).otherwise(1))
    return placed.withColumn("part", F.spark_partition_id())


def _signups_purchases(spark, folder):
    events = ev(spark, folder)

    def side(kind, prefix):
        return events.where(F.col("event_type") == kind).select(
            "user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts")
        )

    return side("signup", "l"), side("purchase", "r")


_SIDES = """
    l AS (SELECT user_id, event_id AS l_id, ts AS l_ts FROM events WHERE event_type = 'signup'),
    r AS (SELECT user_id, event_id AS r_id, ts AS r_ts FROM events WHERE event_type = 'purchase')
"""
_IN_RANGE = "r_ts >= l_ts - INTERVAL 3 HOUR AND r_ts <= l_ts + INTERVAL 5 HOUR"


@query("interval_join", f"WITH {_SIDES} SELECT l.user_id, l_id, l_ts, r_id, r_ts FROM l JOIN r ON l.user_id = r.user_id AND {_IN_RANGE}")
def interval_join(spark, folder):
    left, right = _signups_purchases(spark, folder)
    return combine.interval_join(left, right, ["user_id"], "l_ts", "r_ts", "-3 hours", "5 hours")


@query(
    "interval_join_orders",
    """
    SELECT o_orderkey AS orderkey, o_orderdate, l_linenumber, l_shipdate FROM orders JOIN lineitem
    ON o_orderkey = l_orderkey AND l_shipdate >= o_orderdate - INTERVAL 3 DAY AND l_shipdate <= o_orderdate + INTERVAL 5 DAY
    """,
)
def interval_join_orders(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderdate")
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_shipdate"
    )
    return combine.interval_join(orders, lines, ["orderkey"], "o_orderdate", "l_shipdate", "-3 days", "5 days")


@query(
    "match_or_report",
    f"""
    WITH {_SIDES} SELECT coalesce(l.user_id, r.user_id) AS user_id, l_id, l_ts, r_id, r_ts,
    CASE WHEN r_id IS NULL THEN 'left_only' WHEN l_id IS NULL THEN 'right_only' ELSE 'matched' END AS status
    FROM l FULL JOIN r ON l.user_id = r.user_id AND {_IN_RANGE}
    """,
)
def match_or_report(spark, folder):
    left, right = _signups_purchases(spark, folder)
    return combine.match_two(left, right, ["user_id"], "l_ts", "r_ts", "5 hours", "3 hours")


@query(
    "connect_map",
    f"""
    WITH {EV} SELECT CAST(user_id AS VARCHAR) AS id, value AS temperature, 'warning' AS label FROM ev WHERE value > 30.0
    UNION ALL SELECT CAST(user_id AS VARCHAR), NULL, 'ok' FROM ev WHERE value <= 30.0
    """,
)
def connect_map(spark, folder):
    parts = route.route(ev(spark, folder), {"high": F.col("value") > 30.0}, default="low")
    high = parts["high"].select(F.col("user_id").cast("string").alias("id"), "value")
    low = parts["low"].select("user_id")
    return combine.co_map(
        high,
        {"id": F.col("id"), "temperature": F.col("value"), "label": F.lit("warning")},
        low,
        {"id": F.col("user_id").cast("string"), "temperature": F.lit(None).cast("double"), "label": F.lit("ok")},
    )


_PARTS_SQL = f"""
    WITH {EV}, p AS (SELECT event_id, unnest(string_split(event_type || '_' || CAST(k AS VARCHAR), '_')) AS word FROM ev)
    SELECT event_id, word, CAST(length(word) AS BIGINT) AS length FROM p
"""


def _with_id(spark, folder):
    return ev(spark, folder).select("event_id", F.concat_ws("_", "event_type", "k").alias("id"))


@query("lateral_udtf", _PARTS_SQL)
def lateral_udtf(spark, folder):
    return combine.lateral(_with_id(spark, folder), udfs.word_lengths(F.col("id"))).drop("id")


@query("udtf_split", _PARTS_SQL)
def udtf_split(spark, folder):
    udfs.register(spark)
    return spark.sql("SELECT event_id, word, length FROM {src}, LATERAL split_words(id, '_')", src=_with_id(spark, folder))


@query(
    "union_all",
    """
    SELECT event_id, value FROM events WHERE value > 30.0 UNION ALL SELECT event_id, value FROM events WHERE value <= 30.0
    UNION ALL SELECT event_id, value FROM events
    """,
)
def union_all(spark, folder):
    rows = ev(spark, folder).select("event_id", "value")
    parts = route.route(rows, {"high": F.col("value") > 30.0}, default="low")
    return combine.union_all(parts["high"], parts["low"], rows)


_HASH = """
    list_reduce(list_transform(string_split(id, ''), lambda c: CAST(ascii(c) AS BIGINT)),
                lambda a, c: (a * 31 + c) & 4294967295, CAST(0 AS BIGINT))
"""


@query(
    "udf_hash_code",
    f"""
    WITH {EV}, h AS (SELECT event_id, event_type || '_' || CAST(k AS VARCHAR) AS id FROM ev), g AS (SELECT *, {_HASH} AS h FROM h)
    SELECT event_id, id, CAST(23 * (CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) AS BIGINT) AS hash_code FROM g
    """,
)
def udf_hash_code(spark, folder):
    return _with_id(spark, folder).withColumn("hash_code", hash_code(F.col("id"), 23))


@query("udaf_avg", "SELECT user_id, round(avg(value), 6) AS avg_temp FROM events GROUP BY user_id")
def udaf_avg(spark, folder):
    out = udfs.average(ev(spark, folder), "user_id", "value", "avg_temp")
    return out.withColumn("avg_temp", F.round("avg_temp", 6))


_TOP2 = """
    SELECT user_id, value, CAST(rank AS INTEGER) AS rank FROM (SELECT user_id, value,
    row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events WHERE value > 0) WHERE rank <= 2
"""


@query("udtaf_top2", _TOP2)
def udtaf_top2(spark, folder):
    return udfs.top2(ev(spark, folder), "user_id", "value")


@query("top2_per_key", _TOP2)
def top2_per_key(spark, folder):
    return top_k_values(ev(spark, folder), "user_id", "value", 2, tie="event_id")
