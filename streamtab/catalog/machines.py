"""The pattern, window and rolling jobs on streams: several batches out of order, rows handled behind the watermark."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamtab.catalog import patterns
from streamtab.catalog.aggregates import ORDER, _LATE, arrivals
from streamtab.catalog.base import ev_stream, query
from streamtab.catalog.streams import _MILLIS, USER, _processed, _timed_ms, timed
from streamtab.functions.times import epoch_us, micros
from streamtab.streaming import jobs, machines
from streamtab.streaming.run import drain

_HOUR = 3_600_000
_W = "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"
_ROWS = f"rows_done AS (SELECT * FROM {_MILLIS})"


@query(
    "stream_click_cap",
    f"""
    WITH {_ROWS}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts + INTERVAL 8 HOUR AS DATE)
        ORDER BY ts, event_id) AS rn FROM rows_done)
    SELECT user_id, event_type, event_id, CASE WHEN rn <= 3 THEN 'passed' ELSE 'warned' END AS status FROM r WHERE rn <= 4
    """,
)
def stream_click_cap(spark, folder):
    """Passed clicks and the one warning of a day."""
    schema = "user_id bigint, event_type string, event_id bigint, status string"
    machine = machines.CapPerDay(3, 8 * _HOUR)
    return _processed(spark, folder, machine, schema, _timed_ms(spark, folder), ["user_id", "event_type"])


def _flagged(spark, folder):
    return _timed_ms(spark, folder).withColumn("is_new", F.when(F.col("event_type") == "signup", "1").otherwise("0"))


_FIXED = f"""
    {_ROWS}, f AS (SELECT *, sum(CAST(event_type = 'signup' AS INTEGER)) OVER w AS seen,
        min(CASE WHEN event_type = 'signup' THEN ts END) OVER w AS first_ts FROM rows_done {_W}),
    fixed AS (SELECT *, CASE WHEN event_type = 'signup' AND seen = 1 THEN '1' ELSE '0' END AS is_new FROM f)
"""


@query(
    "stream_fix_new_flag",
    f"WITH {_FIXED} SELECT user_id, event_id, is_new, strftime(first_ts, '%Y-%m-%d') AS first_visit FROM fixed",
)
def stream_fix_new_flag(spark, folder):
    schema = "user_id bigint, event_id bigint, is_new string, first_visit string"
    return _processed(spark, folder, machines.FixNewFlag("is_new"), schema, _flagged(spark, folder))


@query(
    "stream_daily_uv",
    f"""
    WITH {_FIXED} SELECT user_id, event_id, is_new, ts FROM fixed WHERE event_type IN ('view', 'signup')
    QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1
    """,
)
def stream_daily_uv(spark, folder):
    rows = _flagged(spark, folder).withColumn("page", F.col("event_type").isin("view", "signup"))
    schema = "user_id bigint, event_id bigint, is_new string, ts timestamp_ntz"
    return _processed(spark, folder, machines.DailyVisit("is_new", "page"), schema, rows)


@query(
    "stream_followed_by",
    f"""
    WITH {_ROWS}, n AS (SELECT *, min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM rows_done),
    o AS (SELECT user_id, event_id, CASE WHEN nxt < ts + INTERVAL 24 HOUR THEN nxt END AS then_ts,
        ts + INTERVAL 24 HOUR AS deadline FROM n WHERE event_type = 'signup')
    SELECT *, CASE WHEN then_ts IS NULL THEN 'timeout' ELSE 'matched' END AS status FROM o
    """,
)
def stream_followed_by(spark, folder):
    rows = _timed_ms(spark, folder).withColumns({"opens": F.col("event_type") == "signup", "closes": F.col("event_type") == "purchase"})
    schema = "user_id bigint, event_id bigint, then_ts timestamp_ntz, deadline timestamp_ntz, status string"
    return _processed(spark, folder, machines.FollowedBy("opens", "closes", 24 * _HOUR), schema, rows)


@query(
    "stream_repeat_fail",
    f"""
    WITH {_ROWS} SELECT user_id, event_id, first_ts, ts AS last_ts FROM (SELECT *, lag(ts, 2) OVER w AS first_ts,
    lag(event_type) OVER w AS t1, lag(event_type, 2) OVER w AS t2 FROM rows_done {_W})
    WHERE event_type = 'error' AND t1 = 'error' AND t2 = 'error' AND ts - first_ts < INTERVAL 72 HOUR
    """,
)
def stream_repeat_fail(spark, folder):
    rows = _timed_ms(spark, folder).withColumn("failed", F.col("event_type") == "error")
    schema = "user_id bigint, event_id bigint, first_ts timestamp_ntz, last_ts timestamp_ntz"
    return _processed(spark, folder, machines.Consecutive("failed", 3, 72 * _HOUR, inclusive=False), schema, rows)


@query(
    "stream_strict_sequence",
    f"""
    WITH {_ROWS} SELECT user_id, event_id, ts AS first_ts, last_ts FROM (SELECT *, lead(ts, 2) OVER w AS last_ts,
    lead(event_type) OVER w AS t1, lead(event_type, 2) OVER w AS t2 FROM rows_done {_W})
    WHERE event_type = 'view' AND t1 = 'click' AND t2 = 'purchase' AND last_ts - ts < INTERVAL 48 HOUR
    """,
)
def stream_strict_sequence(spark, folder):
    machine = machines.StrictSequence("event_type", ["view", "click", "purchase"], 48 * _HOUR)
    schema = "user_id bigint, event_id bigint, first_ts timestamp_ntz, last_ts timestamp_ntz"
    return _processed(spark, folder, machine, schema, _timed_ms(spark, folder))


def _mean(values):
    return sum(values) / len(values)


def _count_sql(agg: str, step: int) -> str:
    return f"""
    WITH {_ROWS} SELECT user_id, event_id, row_no, {agg} FROM (SELECT *, row_number() OVER w AS row_no,
        avg(value) OVER f AS mean, max(value) OVER f AS hi FROM rows_done WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id),
        f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
    WHERE row_no % {step} = 0
    """


@query("stream_count_slide_avg", _count_sql("round(mean, 6) AS mean", 2))
def stream_count_slide_avg(spark, folder):
    schema = "user_id bigint, event_id bigint, row_no bigint, mean double"
    out = _processed(spark, folder, machines.CountWindow("value", 10, 2, _mean), schema, _timed_ms(spark, folder))
    return out.withColumn("mean", F.round("mean", 6))


@query("stream_count_slide_max", _count_sql("hi", 3))
def stream_count_slide_max(spark, folder):
    schema = "user_id bigint, event_id bigint, row_no bigint, hi double"
    return _processed(spark, folder, machines.CountWindow("value", 10, 3, max), schema, _timed_ms(spark, folder))


@query(
    "stream_rolling",
    f"""
    WITH {_ROWS} SELECT user_id, event_id, count(*) OVER w AS seq, round(sum(value) OVER w, 3) AS total, max(value) OVER w AS hi,
    -(max({{'v': value, 't': -epoch_us(ts), 'e': -event_id}}) OVER w).e AS holder FROM rows_done {_W}
    """,
)
def stream_rolling(spark, folder):
    """Rolling sum, maximum, row of the maximum and count."""
    schema = "user_id bigint, event_id bigint, seq bigint, total double, hi double, holder bigint"
    out = _processed(spark, folder, machines.Rolling("value"), schema, _timed_ms(spark, folder))
    return out.withColumn("total", F.round("total", 3))


@query(
    "stream_top2",
    f"""
    WITH {_ROWS}, t AS (SELECT user_id, event_id, ts, list_slice(list_reverse_sort(list(value) FILTER (value > 0) OVER w), 1, 2) AS top
        FROM rows_done {_W}),
    c AS (SELECT *, lag(top) OVER w AS before FROM t {_W}), d AS (SELECT * FROM c WHERE top IS NOT NULL AND top IS DISTINCT FROM before)
    SELECT user_id, event_id, CAST(i AS BIGINT) AS rank, top[i] AS value
    FROM (SELECT *, unnest(generate_series(1, len(top))) AS i FROM d)
    """,
)
def stream_top2(spark, folder):
    schema = "user_id bigint, event_id bigint, rank bigint, value double"
    return _processed(spark, folder, machines.TopValues("value", 2), schema, _timed_ms(spark, folder))


@query("stream_split_late", f"{_LATE} SELECT event_id, window_end, tag FROM t")
def stream_split_late(spark, folder):
    """Rows that came after their window had closed, apart from the rest; the watermark is carried over batches."""
    out = jobs.late_flags(arrivals(ev_stream(spark, folder, 7200)), ["arrival", "event_id"], "ts", "2 minutes")
    size = F.lit(micros("15 minutes"))
    end = F.timestamp_micros((F.floor(epoch_us("ts") / size) + 1) * size)
    late = F.coalesce(epoch_us(end) + micros("1 minute") <= epoch_us("watermark"), F.lit(False))
    return out.select("event_id", end.alias("window_end"), F.when(late, "late").otherwise("on_time").alias("tag"))


@query("stream_match_steps", patterns._STEPS)
def stream_match_steps(spark, folder):
    matches = machines.match_steps(timed(spark, folder), USER, ORDER, patterns.pattern_of_steps(), "7 days")
    return patterns.step_times(drain(matches, "steps"))
