"""Counts, rolling aggregates and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamtab.catalog.base import EV, HOPS, ev, query
from streamtab.catalog.sources import app_log_json
from streamtab.functions.times import epoch_us, from_us
from streamtab.operators import aggregate, eventtime, over, windows
from streamtab.operators.scan import running_count
from streamtab.plans import jobs
from streamtab.sources.files import table
from streamtab.sources.parse import app_log_days, parse_app_log

ORDER = ["ts", "event_id"]
COUNT = {"cnt": ("count", "*")}


@query(
    "word_count",
    """
    SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents
    WHERE text = '' OR rtrim(text, ' ') <> '') GROUP BY word
    """,
)
def word_count(spark, folder):
    return aggregate.word_count(table(spark, folder, "documents"), "text")


_COUNT_AVG = "SELECT user_id, count(*) AS cnt, round(avg(value), 6) AS avg_value FROM events GROUP BY user_id"


@query("group_count_avg", _COUNT_AVG)
def group_count_avg(spark, folder):
    aggs = {"cnt": F.count("*"), "avg_value": F.round(F.avg("value"), 6)}
    return aggregate.group_agg(ev(spark, folder), ["user_id"], aggs)


@query("group_count_avg_sql", _COUNT_AVG)
def group_count_avg_sql(spark, folder):
    return spark.sql(
        "SELECT user_id, count(*) AS cnt, round(avg(value), 6) AS avg_value FROM {src} GROUP BY user_id",
        src=ev(spark, folder),
    )


_W = "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _rolling(spark, folder, kind):
    rows = ev(spark, folder).select("user_id", "ts", "event_id", "value")
    return over.rolling(rows, ["user_id"], ORDER, kind, "value")


def _rolling_sql(kind):
    return f"""
    SELECT user_id, first(ts) OVER w AS ts, first(event_id) OVER w AS event_id, {kind} AS value,
    count(*) OVER w AS seq FROM events {_W}
    """


@query("rolling_sum", _rolling_sql("round(sum(value) OVER w, 4)"))
def rolling_sum(spark, folder):
    return _rolling(spark, folder, "sum").withColumn("value", F.round("value", 4))


@query("rolling_max", _rolling_sql("max(value) OVER w"))
def rolling_max(spark, folder):
    return _rolling(spark, folder, "max")


@query(
    "rolling_max_by",
    f"""
    WITH r AS (SELECT user_id, max({{'v': value, 't': -epoch_us(ts), 'e': -event_id}}) OVER w AS b, count(*) OVER w AS seq
        FROM events {_W})
    SELECT user_id, make_timestamp(-b.t) AS ts, -b.e AS event_id, b.v AS value, seq FROM r
    """,
)
def rolling_max_by(spark, folder):
    return _rolling(spark, folder, "max_by")


@query(
    "rolling_reduce",
    f"SELECT user_id, ts, event_id, max(value) OVER w AS value, count(*) OVER w AS seq FROM events {_W}",
)
def rolling_reduce(spark, folder):
    return _rolling(spark, folder, "reduce")


@query("keyed_running_count", f"SELECT user_id, event_id, count(*) OVER w AS seq FROM events {_W}")
def keyed_running_count(spark, folder):
    return over.rolling(ev(spark, folder), ["user_id"], ORDER, "count").select("user_id", "event_id", "seq")


@query("global_running_count", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS n FROM events")
def global_running_count(spark, folder):
    return running_count(ev(spark, folder).select(*ORDER), ORDER).select("event_id", "n")


@query("distinct_count", f"WITH {EV} SELECT user_id, count(DISTINCT k) AS cnt FROM ev GROUP BY user_id")
def distinct_count(spark, folder):
    return aggregate.distinct_counts(ev(spark, folder), ["user_id"], {"cnt": ("k", None)})


_GATED = {
    "uv": ("k", None),
    "app_uv": ("k", "event_type IN ('view', 'click')"),
    "web_uv": ("k", "event_type IN ('signup', 'purchase')"),
}


def _gated_sql(case: bool) -> str:
    def one(n, c, cond):
        if not cond:
            return f"count(DISTINCT {c}) AS {n}"
        if case:
            return f"count(DISTINCT CASE WHEN {cond} THEN {c} END) AS {n}"
        return f"count(DISTINCT {c}) FILTER (WHERE {cond}) AS {n}"

    return f"WITH {EV} SELECT user_id, {', '.join(one(n, *g) for n, g in _GATED.items())} FROM ev GROUP BY user_id"


@query("distinct_count_case", _gated_sql(True))
def distinct_count_case(spark, folder):
    return aggregate.distinct_counts(ev(spark, folder), ["user_id"], _GATED)


@query("distinct_count_filter", _gated_sql(False))
def distinct_count_filter(spark, folder):
    return aggregate.distinct_counts_filter(ev(spark, folder), ["user_id"], _GATED)


@query(
    "day_key_count",
    "SELECT strftime(ts, '%Y%m%d') AS day, CAST(user_id AS VARCHAR) AS mid, count(*) AS cnt FROM events GROUP BY 1, 2",
)
def day_key_count(spark, folder):
    logs = app_log_days(parse_app_log(app_log_json(ev(spark, folder))))
    return logs.groupBy("day", "mid").agg(F.count("*").alias("cnt"))


@query("two_phase_local", "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def two_phase_local(spark, folder):
    return aggregate.preagg_count(ev(spark, folder), ["event_type"])


@query(
    "salted_window_count",
    """
    SELECT event_type, time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS cnt
    FROM events GROUP BY 1, 2
    """,
)
def salted_window_count(spark, folder):
    return aggregate.salted_window_count(ev(spark, folder), "ts", ["event_type"], "1 hour", "event_id", 5)


@query(
    "salted_page_views",
    """
    SELECT 'pv' AS label, time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS cnt
    FROM events WHERE event_type = 'view' GROUP BY 2
    """,
)
def salted_page_views(spark, folder):
    return jobs.page_views(ev(spark, folder).where("event_type = 'view'"), "ts", "event_id")


@query("split_distinct", "SELECT event_type, count(DISTINCT user_id) AS cnt FROM events GROUP BY event_type")
def split_distinct(spark, folder):
    return aggregate.split_count_distinct(ev(spark, folder), ["event_type"], "user_id")


def _tumble_sql(keys: str, size: str, aggs: str, where: str = "true") -> str:
    return f"""
    WITH {EV} SELECT {keys}, time_bucket(INTERVAL '{size}', ts) AS window_start,
    time_bucket(INTERVAL '{size}', ts) + INTERVAL '{size}' AS window_end, {aggs} FROM ev WHERE {where} GROUP BY ALL
    """


@query("tumbling_count", _tumble_sql("event_type", "1 hour", "count(*) AS cnt"))
def tumbling_count(spark, folder):
    return windows.tumble(ev(spark, folder), "ts", "1 hour", ["event_type"], {"cnt": F.count("*")})


@query(
    "tumbling_full",
    """
    SELECT user_id, time_bucket(INTERVAL '1 day', ts) + INTERVAL 1 DAY AS window_end, count(*) AS size
    FROM events GROUP BY 1, 2
    """,
)
def tumbling_full(spark, folder):
    return windows.tumble(ev(spark, folder), "ts", "1 day", ["user_id"], {"size": F.count("*")}).drop("window_start")


@query(
    "tumbling_min_by",
    """
    SELECT user_id, time_bucket(INTERVAL '1 day', ts) + INTERVAL 1 DAY AS window_end, ts, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, window_end ORDER BY value, ts, event_id) = 1
    """,
)
def tumbling_min_by(spark, folder):
    rows = ev(spark, folder).select("user_id", "ts", "event_id", "value")
    best = windows.tumble(rows, "ts", "1 day", ["user_id"], {"row": windows.extreme_row(rows, "value", ORDER)})
    return best.select("user_id", "window_end", "row.ts", "row.event_id", "row.value")


_ARRIVALS = "arr AS (SELECT *, ts + to_seconds((event_id * 7919) % 7200) AS arrival FROM events)"


def arrivals(rows):
    """Out-of-order arrival: the event's time plus up to two hours that depend on its id."""
    shift = F.pmod(F.col("event_id") * 7919, F.lit(7200)) * 1_000_000
    return rows.withColumn("arrival", from_us(epoch_us("ts") + shift).cast("timestamp_ntz"))


_LATE = f"""
    WITH {_ARRIVALS}, w AS (SELECT *, max(ts) OVER (ORDER BY arrival, event_id) - INTERVAL '2 minutes' AS watermark,
        time_bucket(INTERVAL '15 minutes', ts) + INTERVAL '15 minutes' AS window_end FROM arr),
    t AS (SELECT *, CASE WHEN window_end + INTERVAL '1 minute' <= watermark THEN 'late' ELSE 'on_time' END AS tag FROM w)
"""


def _split(spark, folder):
    rows = arrivals(ev(spark, folder).drop("k"))
    return eventtime.split_late(rows, "ts", ["arrival", "event_id"], "15 minutes", "2 minutes", "1 minute")


@query("split_late", _LATE + "SELECT event_id, ts, tag FROM t")
def split_late(spark, folder):
    return _split(spark, folder).select("event_id", "ts", "tag")


@query(
    "tumbling_max_late",
    _LATE
    + """
    SELECT user_id, window_end, tag, max(value) AS max_value, count(*) AS n FROM t WHERE tag = 'on_time' GROUP BY ALL
    UNION ALL SELECT user_id, window_end, tag, value, 1 FROM t WHERE tag = 'late'
    """,
)
def tumbling_max_late(spark, folder):
    tagged = _split(spark, folder)
    aggs = {"max_value": F.max("value"), "n": F.count("*")}
    kept = windows.tumble(tagged.where("tag = 'on_time'"), "ts", "15 minutes", ["user_id", "tag"], aggs)
    late = tagged.where("tag = 'late'").select(
        "user_id", "tag", F.window("ts", "15 minutes")["end"].alias("window_end"), F.col("value").alias("max_value"),
        F.lit(1).cast("bigint").alias("n"),
    )
    return kept.drop("window_start").unionByName(late)


_TABLE_TUMBLE = _tumble_sql("user_id", "1 hour", "count(*) AS cnt, round(avg(value), 6) AS avg_value")


@query("table_tumble", _TABLE_TUMBLE)
def table_tumble(spark, folder):
    aggs = {"cnt": F.count("*"), "avg_value": F.round(F.avg("value"), 6)}
    return windows.tumble(ev(spark, folder), "ts", "1 hour", ["user_id"], aggs)


@query("table_tumble_sql", _TABLE_TUMBLE)
def table_tumble_sql(spark, folder):
    return spark.sql(
        """
        SELECT user_id, w.start AS window_start, w.end AS window_end, count(*) AS cnt, round(avg(value), 6) AS avg_value
        FROM (SELECT user_id, value, window(ts, '1 hour') AS w FROM {src}) GROUP BY user_id, w
        """,
        src=ev(spark, folder),
    )


@query("sliding_count", f"WITH {EV}, {HOPS} SELECT k, window_end, count(*) AS cnt FROM hops GROUP BY ALL")
def sliding_count(spark, folder):
    return windows.slide(ev(spark, folder), "ts", "1 hour", "5 minutes", ["k"], COUNT)


_MINUTES = """
    hops AS (SELECT ev.*, time_bucket(INTERVAL '1 minute', ts) + (i * INTERVAL '1 minute') AS window_end
    FROM ev, (SELECT unnest(generate_series(1, 60)) AS i))
"""


def _marketing(spark, folder):
    channel = F.concat(F.lit("ch"), F.pmod("user_id", F.lit(3)))
    return ev(spark, folder).select("ts", channel.alias("channel"), F.col("event_type").alias("behavior"))


@query(
    "channel_counts",
    f"""
    WITH {EV}, {_MINUTES} SELECT 'ch' || CAST(user_id % 3 AS VARCHAR) AS channel, event_type AS behavior, window_end,
    count(*) AS cnt FROM hops WHERE event_type <> 'error' GROUP BY ALL
    """,
)
def channel_counts(spark, folder):
    return jobs.channel_counts(_marketing(spark, folder), "ts", "channel", "behavior", "error", "1 hour", "1 minute")


@query(
    "channel_total",
    f"""
    WITH {EV}, {_MINUTES} SELECT 'total' AS channel, 'total' AS behavior, window_end, count(*) AS cnt
    FROM hops WHERE event_type <> 'error' GROUP BY ALL
    """,
)
def channel_total(spark, folder):
    return jobs.channel_total(_marketing(spark, folder), "ts", "behavior", "error", "1 hour", "1 minute")


@query(
    "pane_slide",
    f"""
    WITH {EV}, {_MINUTES} SELECT event_type, window_end, count(*) AS cnt, round(sum(value), 4) AS total, min(value) AS lo,
    max(value) AS hi, round(avg(value), 6) AS mean FROM hops GROUP BY ALL
    """,
)
def pane_slide(spark, folder):
    aggs = {
        "cnt": ("count", "*"), "total": ("sum", "value"), "lo": ("min", "value"), "hi": ("max", "value"),
        "mean": ("avg", "value"),
    }
    out = windows.slide(ev(spark, folder), "ts", "1 hour", "1 minute", ["event_type"], aggs, "panes")
    return out.withColumns({"total": F.round("total", 4), "mean": F.round("mean", 6)})


@query(
    "session_window",
    """
    WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM g)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS cnt,
    max(value) AS hi FROM s GROUP BY user_id, sid
    """,
)
def session_window(spark, folder):
    aggs = {"cnt": F.count("*"), "hi": F.max("value")}
    return windows.session(ev(spark, folder), "ts", "2 hours", ["user_id"], aggs, tie=["event_id"])


def _count_window_sql(agg: str, step: int) -> str:
    return f"""
    SELECT user_id, event_id, row_no, {agg} FROM (SELECT *, row_number() OVER w AS row_no,
        avg(value) OVER f AS mean, max(value) OVER f AS hi FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id),
        f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
    WHERE row_no % {step} = 0
    """


@query("count_slide_avg", _count_window_sql("round(mean, 6) AS mean", 2))
def count_slide_avg(spark, folder):
    out = windows.count_window(ev(spark, folder), ["user_id"], ORDER, 10, 2, F.avg("value"), "mean")
    return out.select("user_id", "event_id", "row_no", F.round("mean", 6).alias("mean"))


@query("count_slide_max", _count_window_sql("hi", 3))
def count_slide_max(spark, folder):
    out = windows.count_window(ev(spark, folder), ["user_id"], ORDER, 10, 3, F.max("value"), "hi")
    return out.select("user_id", "event_id", "row_no", "hi")


_HOUR_END = "time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR"
_SLOT = """
    list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                lambda a, c: (a * 61 + c) & 536870911, CAST(0 AS BIGINT))
"""


def _views(spark, folder):
    return ev(spark, folder).where("event_type = 'view'")


@query(
    "hourly_uv",
    f"SELECT {_HOUR_END} AS window_end, count(DISTINCT user_id) AS uv FROM events WHERE event_type = 'view' GROUP BY 1",
)
def hourly_uv(spark, folder):
    return windows.window_distinct(_views(spark, folder), "ts", "1 hour", "user_id")


@query(
    "hourly_uv_bitmap",
    f"SELECT {_HOUR_END} AS window_end, count(DISTINCT {_SLOT}) AS uv FROM events WHERE event_type = 'view' GROUP BY 1",
)
def hourly_uv_bitmap(spark, folder):
    return windows.bitmap_distinct(_views(spark, folder), "ts", "1 hour", "user_id")


@query(
    "hourly_uv_running",
    f"""
    WITH v AS (SELECT {_HOUR_END} AS window_end, ts, event_id, {_SLOT} AS slot FROM events WHERE event_type = 'view'),
    f AS (SELECT window_end, ts, event_id FROM v QUALIFY row_number() OVER (PARTITION BY window_end, slot ORDER BY ts, event_id) = 1)
    SELECT window_end, ts, event_id, row_number() OVER (PARTITION BY window_end ORDER BY ts, event_id) AS uv FROM f
    """,
)
def hourly_uv_running(spark, folder):
    return windows.running_distinct(_views(spark, folder), "ts", "1 hour", "user_id", "event_id")


@query(
    "hourly_uv_approx",
    f"""
    SELECT {_HOUR_END} AS window_end, count(DISTINCT user_id) AS uv, true AS within FROM events
    WHERE event_type = 'view' GROUP BY 1
    """,
)
def hourly_uv_approx(spark, folder):
    """The exact count of each window, and whether the sketch is within four of its standard errors (5 %), or one, of it."""
    about = windows.window_distinct(_views(spark, folder), "ts", "1 hour", "user_id", approx=True, name="about")
    exact = windows.window_distinct(_views(spark, folder), "ts", "1 hour", "user_id")
    near = F.abs(F.col("about") - F.col("uv")) <= F.greatest(F.lit(1.0), 0.2 * F.col("uv"))
    return exact.join(about, "window_end").select("window_end", "uv", near.alias("within"))
