"""Structured Streaming forms, run over all available files and read back. Append mode gives closed windows only."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamtab.catalog import patterns
from streamtab.catalog.aggregates import ORDER, _ARRIVALS, arrivals
from streamtab.catalog.base import EV, SQL, ev, ev_stream, query
from streamtab.catalog.sources import _REQUEST_URL, requests
from streamtab.functions.text import is_page_request
from streamtab.operators import aggregate, combine, eventtime, windows
from streamtab.functions.times import epoch_us, micros
from streamtab.plans import jobs as batch_jobs
from streamtab.sources.files import table_stream
from streamtab.streaming import jobs, stateful
from streamtab.streaming.run import drain, drain_latest

USER = ["user_id"]
# How long after its time an event may arrive; the watermark stays as far behind.
DISORDER = "30 minutes"


def _before_closing(rows):
    """Without the rows that only move the watermark on; naming the time as well, the condition is not moved before the watermark."""
    return rows.where(F.coalesce(F.col("event_id") * 0, F.unix_micros("ts")) == 0)


def running(spark, folder, delay=DISORDER):
    """Events that arrive as much out of order as the watermark's delay allows; in the end the watermark is so far behind the last."""
    return eventtime.with_event_time(ev_stream(spark, folder, micros(delay) // 1_000_000), "ts", delay)


def timed(spark, folder, delay=DISORDER):
    """The same events, with the watermark beyond the last of them in the end."""
    rows = ev_stream(spark, folder, micros(delay) // 1_000_000, closed=True)
    return _before_closing(eventtime.with_event_time(rows, "ts", delay))


def _closed_counts(delay: str) -> str:
    return f"""
    SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS window_start,
    time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS cnt FROM events GROUP BY 1, 2, 3
    HAVING time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL '{delay}'
    """


def _hourly(spark, folder, delay):
    counts = windows.tumble(running(spark, folder, delay), "ts", "1 hour", ["event_type"], {"cnt": F.count("*")})
    return drain(counts, "wm")


@query("wm_ascending", _closed_counts("0 seconds"))
def wm_ascending(spark, folder):
    return _hourly(spark, folder, "0 seconds")


@query("wm_bounded", _closed_counts("3 seconds"))
def wm_bounded(spark, folder):
    return _hourly(spark, folder, "3 seconds")


@query("wm_periodic", _closed_counts("60 seconds"))
def wm_periodic(spark, folder):
    return _hourly(spark, folder, "60 seconds")


@query(
    "allowed_lateness",
    """
    SELECT user_id, time_bucket(INTERVAL '15 minutes', ts) + INTERVAL 15 MINUTE AS window_end, max(value) AS hi
    FROM events GROUP BY ALL
    """,
)
def allowed_lateness(spark, folder):
    """Disorder of 2 minutes and lateness of 1 minute keep a window open for 3; each late row re-emits its window."""
    rows = running(spark, folder, "3 minutes")
    counts = windows.tumble(rows, "ts", "15 minutes", USER, {"hi": F.max("value")}).drop("window_start")
    return drain_latest(counts, "lateness", ["user_id", "window_end"])


@query(
    "stream_word_count",
    """
    SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents
    WHERE text = '' OR rtrim(text, ' ') <> '') GROUP BY word
    """,
)
def stream_word_count(spark, folder):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return drain_latest(aggregate.word_count(table_stream(spark, folder, "documents", schema), "text"), "words", ["word"])


@query(
    "stream_hot_items",
    patterns._HOT_ITEMS,
)
def stream_hot_items(spark, folder):
    return jobs.hot_items(timed(spark, folder).withColumnRenamed("k", "item_id"), "item_id")


@query("stream_hot_pages", SQL["hot_pages"])
def stream_hot_pages(spark, folder):
    views = requests(timed(spark, folder, "1 minute 1 second"))
    return jobs.hot_pages(views, 3, "10 minutes", "5 seconds")


def _marketing(rows):
    channel = F.concat(F.lit("ch"), F.pmod("user_id", F.lit(3)))
    return rows.select("ts", channel.alias("channel"), F.col("event_type").alias("behavior"))


def _per_hour(windows_of: str) -> str:
    """Every window of a key in one row per hour: how many, their sum, the greatest count and a sum that tells their places."""
    return f"""
    SELECT channel, behavior, time_bucket(INTERVAL '1 hour', window_end) AS hour, count(*) AS n_windows, CAST(sum(cnt) AS BIGINT) AS total,
    max(cnt) AS most, CAST(sum(cnt * (epoch_us(window_end) // 1000000 % 3600 + 1)) AS BIGINT) AS placed FROM ({windows_of}) GROUP BY ALL
    """


def _hourly_windows(counts):
    place = F.pmod(F.floor(epoch_us("window_end") / F.lit(1_000_000)), F.lit(3600)) + 1
    return counts.groupBy("channel", "behavior", F.date_trunc("hour", "window_end").alias("hour")).agg(
        F.count("*").alias("n_windows"), F.sum("cnt").alias("total"), F.max("cnt").alias("most"), F.sum(F.col("cnt") * place).alias("placed")
    )


_FIVE_SECONDS = """
    SELECT {key}, time_bucket(INTERVAL '5 seconds', ts) + (i * INTERVAL '5 seconds') AS window_end, count(*) AS cnt
    FROM events, (SELECT unnest(generate_series(1, 720)) AS i) WHERE event_type <> 'error' GROUP BY ALL
"""
_CHANNELS_5S = _per_hour(_FIVE_SECONDS.format(key="'ch' || CAST(user_id % 3 AS VARCHAR) AS channel, event_type AS behavior"))
_TOTAL_5S = _per_hour(_FIVE_SECONDS.format(key="'total' AS channel, 'total' AS behavior"))


@query("channel_counts_5s", _CHANNELS_5S)
def channel_counts_5s(spark, folder):
    """All windows of one hour every five seconds, told by the hour."""
    return _hourly_windows(batch_jobs.channel_counts(_marketing(ev(spark, folder)), "ts", "channel", "behavior", "error"))


@query("channel_total_5s", _TOTAL_5S)
def channel_total_5s(spark, folder):
    return _hourly_windows(batch_jobs.channel_total(_marketing(ev(spark, folder)), "ts", "behavior", "error"))


@query("stream_channel_counts", _CHANNELS_5S)
def stream_channel_counts(spark, folder):
    counts = batch_jobs.channel_counts(_marketing(timed(spark, folder)), "ts", "channel", "behavior", "error")
    return _hourly_windows(drain(counts, "channel_counts"))


@query("stream_channel_total", _TOTAL_5S)
def stream_channel_total(spark, folder):
    counts = batch_jobs.channel_total(_marketing(timed(spark, folder)), "ts", "behavior", "error")
    return _hourly_windows(drain(counts, "channel_total"))


_PANES_1S = """
    SELECT event_type, time_bucket(INTERVAL '1 hour', window_end) AS hour, count(*) AS n_windows, CAST(sum(cnt) AS BIGINT) AS cnt,
    CAST(sum(CAST(round(total * 1000) AS BIGINT)) AS BIGINT) AS total, min(lo) AS lo, max(hi) AS hi,
    CAST(sum(CAST(round((lo + hi) * 1000) AS BIGINT) * (epoch_us(window_end) // 1000000 % 3600 + 1)) AS BIGINT) AS placed FROM (
        SELECT event_type, time_bucket(INTERVAL '1 second', ts) + (i * INTERVAL '1 second') AS window_end, count(*) AS cnt,
        sum(value) AS total, min(value) AS lo, max(value) AS hi
        FROM events, (SELECT unnest(generate_series(1, 3600)) AS i) GROUP BY ALL) GROUP BY ALL
"""


def _hourly_values(spark, folder, rows):
    aggs = {"cnt": ("count", "*"), "total": ("sum", "value"), "lo": ("min", "value"), "hi": ("max", "value")}
    return windows.slide(rows, "ts", "1 hour", "1 second", ["event_type"], aggs)


def _told(out):
    place = F.pmod(F.floor(epoch_us("window_end") / F.lit(1_000_000)), F.lit(3600)) + 1
    thousandths = [F.round(c * 1000).cast("bigint") for c in (F.col("total"), F.col("lo") + F.col("hi"))]
    return out.groupBy("event_type", F.date_trunc("hour", "window_end").alias("hour")).agg(
        F.count("*").alias("n_windows"), F.sum("cnt").alias("cnt"), F.sum(thousandths[0]).alias("total"), F.min("lo").alias("lo"),
        F.max("hi").alias("hi"), F.sum(thousandths[1] * place).alias("placed"),
    )


@query("pane_slide_1s", _PANES_1S)
def pane_slide_1s(spark, folder):
    """Sums and extremes of one hour every second, told by the hour."""
    return _told(_hourly_values(spark, folder, ev(spark, folder)))


@query("stream_pane_slide", _PANES_1S)
def stream_pane_slide(spark, folder):
    return _told(drain(_hourly_values(spark, folder, timed(spark, folder)), "pane_slide"))


@query("stream_salted_window_count", SQL["salted_window_count"])
def stream_salted_window_count(spark, folder):
    """Two windowed aggregates in one stream: by salt, then without."""
    return drain(aggregate.salted_window_count(timed(spark, folder), "ts", ["event_type"], "1 hour", "event_id", 5), "salted")


@query("stream_salted_page_views", SQL["salted_page_views"])
def stream_salted_page_views(spark, folder):
    return drain(batch_jobs.page_views(timed(spark, folder).where("event_type = 'view'"), "ts", "event_id"), "page_views")


@query(
    "stream_hourly_uv",
    f"""
    SELECT time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR AS window_end, count(DISTINCT user_id) AS uv FROM events
    WHERE event_type = 'view' GROUP BY 1
    """,
)
def stream_hourly_uv(spark, folder):
    views = timed(spark, folder).where("event_type = 'view'")
    return drain(windows.window_distinct(views, "ts", "1 hour", "user_id"), "uv")


@query(
    "stream_session",
    f"""
    WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM g)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS cnt FROM s
    GROUP BY user_id, sid
    """,
)
def stream_session(spark, folder):
    return drain(windows.session(timed(spark, folder), "ts", "2 hours", USER, {"cnt": F.count("*")}), "session")


@query(
    "stream_first_visit",
    "SELECT DISTINCT user_id, date_trunc('day', ts) AS day FROM events WHERE event_type = 'view'",
)
def stream_first_visit(spark, folder):
    views = running(spark, folder, "1 day").where("event_type = 'view'")
    out = drain(jobs.first_of_day(views, USER, "ts"), "first_visit")
    return out.select("user_id", F.col("day").cast("timestamp_ntz"))


@query(
    "stream_interval_join",
    """
    SELECT l.user_id, l.event_id AS l_id, l.ts AS l_ts, r.event_id AS r_id, r.ts AS r_ts FROM events l JOIN events r
    ON l.user_id = r.user_id AND l.event_type = 'signup' AND r.event_type = 'purchase'
    AND r.ts >= l.ts - INTERVAL 3 HOUR AND r.ts <= l.ts + INTERVAL 5 HOUR
    """,
)
def stream_interval_join(spark, folder):
    def side(kind, prefix):
        rows = ev_stream(spark, folder, micros(DISORDER) // 1_000_000).where(F.col("event_type") == kind)
        rows = rows.select("user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"))
        return eventtime.with_event_time(rows, f"{prefix}_ts", DISORDER)

    pairs = combine.interval_join(side("signup", "l"), side("purchase", "r"), USER, "l_ts", "r_ts", "-3 hours", "5 hours")
    return drain(pairs, "interval_join")


def _processed(spark, folder, processor, schema, rows=None, keys=USER):
    stream = timed(spark, folder) if rows is None else rows
    return drain(stateful.keyed_process(stream, keys, ORDER, processor, schema), "keyed")


@query(
    "stream_keyed_process",
    patterns._IDLE_SQL,
)
def stream_keyed_process(spark, folder):
    return _processed(spark, folder, stateful.IdleAlert(patterns._IDLE_MS), "user_id bigint, alert_ts timestamp_ntz")


@query(
    "stream_match_stateful",
    patterns._match_sql("true"),
)
def stream_match_stateful(spark, folder):
    rows = patterns.match_rows(timed(spark, folder))
    matcher = stateful.SlotMatcher("side", patterns.MATCH_WAITS)
    return _processed(spark, folder, matcher, patterns.MATCH_SCHEMA, rows)


@query(
    "stream_jump_alert",
    f"""
    SELECT user_id, event_id, value, previous FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)
    AS previous FROM events) WHERE abs(previous - value) > 10.0
    """,
)
def stream_jump_alert(spark, folder):
    schema = "user_id bigint, event_id bigint, value double, previous double"
    return _processed(spark, folder, stateful.JumpAlert("value", 10.0), schema)


@query(
    "stream_running_count",
    f"SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events",
)
def stream_running_count(spark, folder):
    return _processed(spark, folder, stateful.RunningCount(), "user_id bigint, event_id bigint, seq bigint")


@query(
    "stream_over_rows",
    f"""
    SELECT user_id, event_id, count(*) OVER w AS cnt, round(avg(value) OVER w, 4) AS mean FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    """,
)
def stream_over_rows(spark, folder):
    out = _processed(spark, folder, stateful.LastRows("value", 2), "user_id bigint, event_id bigint, cnt bigint, mean double")
    return out.withColumn("mean", F.round("mean", 4))


# Processor timers count milliseconds, so these two read times cut to milliseconds.
_MILLIS = "(SELECT event_id, user_id, event_type, value, date_trunc('millisecond', ts) AS ts FROM events)"


def _timed_ms(spark, folder):
    rows = ev_stream(spark, folder, micros(DISORDER) // 1_000_000, closed=True).withColumn("ts", F.date_trunc("millisecond", "ts"))
    return _before_closing(eventtime.with_event_time(rows, "ts", DISORDER))


@query(
    "stream_rising_alert",
    patterns._runs_sql("value > pv", 12, "user_id, s AS rise_ts, s + INTERVAL 12 HOUR AS alert_ts", _MILLIS),
)
def stream_rising_alert(spark, folder):
    schema = "user_id bigint, rise_ts timestamp_ntz, alert_ts timestamp_ntz"
    return _processed(spark, folder, stateful.RisingAlert("value", 12 * 3_600_000), schema, _timed_ms(spark, folder))


@query(
    "stream_fail_burst",
    patterns._runs_sql("event_type = 'error'", 6, "user_id, s AS start_ts, last_ts, n", _MILLIS)
    + " AND n >= 2",
)
def stream_fail_burst(spark, folder):
    rows = _timed_ms(spark, folder).withColumn("failed", F.col("event_type") == "error")
    schema = "user_id bigint, start_ts timestamp_ntz, last_ts timestamp_ntz, n bigint"
    return _processed(spark, folder, stateful.FailBurst("failed", 6 * 3_600_000, 2), schema, rows)


@query("stream_order_outcome", patterns._OUTCOMES)
def stream_order_outcome(spark, folder):
    machine = stateful.OrderOutcome("event_type", "signup", "purchase", patterns._WAIT)
    return _processed(spark, folder, machine, "user_id bigint, result_state string")


@query(
    "stream_cdc_retract",
    f"""
    WITH c AS (SELECT *, lag(event_id) OVER w AS o_id, lag(value) OVER w AS o_value FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, event_id AS change_id, true AS is_add, event_id AS row_id, value FROM c
    UNION ALL SELECT user_id, event_id, false, o_id, o_value FROM c WHERE o_id IS NOT NULL
    """,
)
def stream_cdc_retract(spark, folder):
    schema = "user_id bigint, change_id bigint, is_add boolean, row_id bigint, value double"
    return _processed(spark, folder, stateful.Retract(), schema)


@query(
    "stream_cdc_current",
    f"""
    WITH {EV} SELECT event_id, ts, user_id, event_type, value, k FROM ev
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AND event_type <> 'error'
    """,
)
def stream_cdc_current(spark, folder):
    latest = jobs.keyed_latest(ev_stream(spark, folder), "cdc", USER, ORDER)
    return latest.where("event_type <> 'error'")


@query(
    "stream_late_flags",
    f"""
    WITH {_ARRIVALS}, w AS (SELECT *, max(CASE WHEN event_type = 'view' THEN ts END) OVER (ORDER BY arrival, event_id)
        - INTERVAL '60 seconds' AS watermark FROM arr)
    SELECT event_id, ts, watermark, coalesce(ts < watermark, false) AS is_late FROM w
    """,
)
def stream_late_flags(spark, folder):
    rows = arrivals(ev_stream(spark, folder, 7200))
    out = jobs.late_flags(rows, ["arrival", "event_id"], "ts", "60 seconds", F.col("event_type") == "view")
    return out.select("event_id", "ts", "watermark", "is_late")
