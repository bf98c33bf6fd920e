"""OVER windows, rankings, event patterns, event time and the composed jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamtab.catalog.aggregates import _ARRIVALS, ORDER, arrivals
from streamtab.catalog.base import EV, HOPS, ev, query
from streamtab.catalog.sources import _REQUEST_URL, requests
from streamtab.functions.times import from_us
from streamtab.operators import eventtime, over, pattern
from streamtab.plans import jobs
from streamtab.sources.files import table
from streamtab.streaming import stateful

USER = ["user_id"]


@query(
    "over_rows",
    """
    SELECT event_id, user_id, count(*) OVER w AS cnt, round(avg(value) OVER w, 4) AS mean FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    """,
)
def over_rows(spark, folder):
    out = over.over_rows(ev(spark, folder), USER, ORDER, 2, {"cnt": F.count("*"), "mean": F.avg("value")})
    return out.select("event_id", "user_id", "cnt", F.round("mean", 4).alias("mean"))


_HOT_ITEMS = f"""
    WITH {EV}, {HOPS}, c AS (SELECT k AS item_id, window_end, count(*) AS cnt FROM hops GROUP BY ALL)
    SELECT item_id, window_end, cnt, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS INTEGER) AS rank
    FROM c QUALIFY rank <= 5
"""


@query("hot_items", _HOT_ITEMS)
def hot_items(spark, folder):
    return jobs.hot_items(ev(spark, folder).withColumnRenamed("k", "item_id"))


@query("topn_sql", _HOT_ITEMS)
def topn_sql(spark, folder):
    return jobs.hot_items_sql(ev(spark, folder).withColumnRenamed("k", "item_id"))


@query(
    "hot_pages",
    f"""
    WITH {EV}, v AS (SELECT *, {_REQUEST_URL} AS url FROM ev WHERE event_type <> 'signup'),
    h AS (SELECT url, time_bucket(INTERVAL '5 seconds', ts) + (i * INTERVAL '5 seconds') AS window_end
        FROM v, (SELECT unnest(generate_series(1, 120)) AS i) WHERE NOT regexp_matches(url, '\\.(css|js|png|ico)$')),
    c AS (SELECT url, window_end, count(*) AS cnt FROM h GROUP BY ALL)
    SELECT url, window_end, cnt, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS INTEGER) AS rank
    FROM c QUALIFY rank <= 3
    """,
)
def hot_pages(spark, folder):
    return jobs.hot_pages(requests(ev(spark, folder)))


@query(
    "jump_alert",
    """
    SELECT user_id, event_id, value, previous FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)
    AS previous FROM events) WHERE abs(previous - value) > 10.0
    """,
)
def jump_alert(spark, folder):
    out = pattern.jump_alert(ev(spark, folder), USER, ORDER, "value", 10.0)
    return out.select("user_id", "event_id", "value", "previous")


_IDLE_MS = 48 * 3600 * 1000
_IDLE_SQL = f"""
    SELECT user_id, make_timestamp((t + {_IDLE_MS}) * 1000) AS alert_ts FROM (SELECT user_id, epoch_us(ts) // 1000 AS t,
    lead(epoch_us(ts) // 1000) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events)
    WHERE nxt IS NULL OR nxt > t + {_IDLE_MS}
"""


@query("keyed_process", _IDLE_SQL)
def keyed_process(spark, folder):
    rows = ev(spark, folder).select("user_id", *ORDER)
    return stateful.keyed_process(rows, USER, ORDER, stateful.IdleAlert(_IDLE_MS), "user_id bigint, alert_ts timestamp_ntz", _IDLE_MS)


def _match_sql(closed: str, handled: str = "true") -> str:
    """The slot machine row by row; `closed` says when a slot left over at the end is reported."""
    return f"""
    WITH RECURSIVE m AS (SELECT user_id, epoch_us(ts) // 1000 AS t, CAST(event_type = 'purchase' AS INTEGER) AS side,
            row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, count(*) OVER (PARTITION BY user_id) AS total
        FROM events WHERE event_type IN ('signup', 'purchase') AND {handled}),
    s AS (SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS l, CAST(NULL AS BIGINT) AS r,
            CAST([] AS BIGINT[]) AS timers, CAST(NULL AS BIGINT) AS out_l, CAST(NULL AS BIGINT) AS out_r,
            CAST(NULL AS BIGINT) AS pair_l, CAST(NULL AS BIGINT) AS pair_r FROM m
        UNION ALL SELECT user_id, n, CASE WHEN side = 0 AND r IS NULL THEN t END, CASE WHEN side = 1 AND l IS NULL THEN t END,
            CASE WHEN side = 0 AND r IS NULL THEN list_append(timers, t + {MATCH_WAITS[0]})
                WHEN side = 1 AND l IS NULL THEN list_append(timers, t + {MATCH_WAITS[1]}) ELSE timers END, out_l, out_r,
            CASE WHEN side = 0 AND r IS NOT NULL THEN t WHEN side = 1 THEN l END,
            CASE WHEN side = 1 AND l IS NOT NULL THEN t WHEN side = 0 THEN r END
        FROM (SELECT user_id, n, t, side, CASE WHEN NOT fired THEN l END AS l, CASE WHEN NOT fired THEN r END AS r,
            list_filter(timers, lambda x: x >= t) AS timers, CASE WHEN fired THEN l END AS out_l, CASE WHEN fired THEN r END AS out_r
            FROM (SELECT m.*, s.l, s.r, s.timers, len(list_filter(s.timers, lambda x: x < m.t)) > 0 AS fired
                FROM s JOIN m ON s.user_id = m.user_id AND m.n = s.n + 1))),
    e AS (SELECT s.* FROM s JOIN m ON s.user_id = m.user_id AND s.n = m.n AND m.n = m.total WHERE {closed}),
    o AS (SELECT user_id, 'matched' AS status, pair_l AS l, pair_r AS r FROM s WHERE pair_l IS NOT NULL AND pair_r IS NOT NULL
        UNION ALL SELECT user_id, 'left_only', out_l, NULL FROM s WHERE out_l IS NOT NULL
        UNION ALL SELECT user_id, 'right_only', NULL, out_r FROM s WHERE out_r IS NOT NULL
        UNION ALL SELECT user_id, 'left_only', l, NULL FROM e WHERE l IS NOT NULL
        UNION ALL SELECT user_id, 'right_only', NULL, r FROM e WHERE r IS NOT NULL)
    SELECT user_id, status, make_timestamp(l * 1000) AS l_ts, make_timestamp(r * 1000) AS r_ts FROM o
    """


MATCH_WAITS = (5 * 3600 * 1000, 3 * 3600 * 1000)
MATCH_SCHEMA = "user_id bigint, status string, l_ts timestamp_ntz, r_ts timestamp_ntz"


@query("match_stateful", _match_sql("true"))
def match_stateful(spark, folder):
    rows = match_rows(ev(spark, folder))
    return stateful.keyed_process(
        rows, USER, ORDER, stateful.SlotMatcher("side", MATCH_WAITS), MATCH_SCHEMA, max(MATCH_WAITS)
    )



def match_rows(events):
    """Sign-ups (side 0) and purchases (side 1) as one tagged table."""
    side = F.when(F.col("event_type") == "signup", 0).when(F.col("event_type") == "purchase", 1)
    return events.select("user_id", *ORDER, side.alias("side")).where("side IS NOT NULL")


def _runs_sql(member: str, hours: int, tail: str, source: str = "events") -> str:
    """Greedy timed runs of `member` rows by recursion."""
    return f"""
    WITH RECURSIVE b AS (SELECT *, coalesce({member}, false) AS m FROM (SELECT *, lag(value) OVER
            (PARTITION BY user_id ORDER BY ts, event_id) AS pv FROM {source})),
    i AS (SELECT *, sum(CASE WHEN m THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM b),
    f AS (SELECT user_id, island, ts FROM i WHERE m),
    x AS (SELECT user_id, island - 1 AS island, ts AS break_ts FROM i WHERE NOT m),
    c AS (SELECT user_id, island, min(ts) AS s FROM f GROUP BY ALL
        UNION ALL SELECT c.user_id, c.island, min(f.ts) FROM c JOIN f ON c.user_id = f.user_id AND c.island = f.island
        AND f.ts > c.s + INTERVAL {hours} HOUR GROUP BY ALL),
    r AS (SELECT c.user_id, c.s, max(f.ts) AS last_ts, count(*) AS n, any_value(x.break_ts) AS break_ts
        FROM c JOIN f ON c.user_id = f.user_id AND c.island = f.island AND f.ts >= c.s AND f.ts <= c.s + INTERVAL {hours} HOUR
        LEFT JOIN x ON c.user_id = x.user_id AND c.island = x.island GROUP BY c.user_id, c.s)
    SELECT {tail} FROM r WHERE coalesce(break_ts > s + INTERVAL {hours} HOUR, true)
    """


@query("fail_burst", _runs_sql("event_type = 'error'", 6, "user_id, s AS start_ts, last_ts, n") + " AND n >= 2")
def fail_burst(spark, folder):
    return pattern.fail_burst(ev(spark, folder), USER, ORDER, F.col("event_type") == "error", "6 hours", 2)


@query(
    "rising_alert",
    _runs_sql("value > pv", 12, "user_id, s AS rise_ts, s + INTERVAL 12 HOUR AS alert_ts"),
)
def rising_alert(spark, folder):
    return pattern.rising_alert(ev(spark, folder), USER, ORDER, "value", "12 hours")


_FLAGGED = "fl AS (SELECT *, CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new FROM events)"
_FIXED = f"""
    {_FLAGGED}, n AS (SELECT *, sum(CAST(is_new AS INTEGER)) OVER w AS seen,
        min(CASE WHEN is_new = '1' THEN ts END) OVER w AS f FROM fl WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    fixed AS (SELECT event_id, user_id, event_type, ts, CASE WHEN is_new = '1' AND seen > 1 THEN '0' ELSE is_new END AS is_new,
        strftime(f, '%Y-%m-%d') AS first_visit FROM n)
"""


def _flagged(spark, folder):
    return ev(spark, folder).withColumn("is_new", F.when(F.col("event_type") == "signup", "1").otherwise("0"))


@query("fix_new_flag", f"WITH {_FIXED} SELECT event_id, user_id, is_new, first_visit FROM fixed")
def fix_new_flag(spark, folder):
    out = pattern.fix_new_flag(_flagged(spark, folder), USER, ORDER, "is_new")
    return out.select("event_id", "user_id", "is_new", "first_visit")


_FIRST_OF_DAY = """
    QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1
"""


@query("first_visit_of_day", f"SELECT event_id, user_id, ts FROM events WHERE event_type = 'view' {_FIRST_OF_DAY}")
def first_visit_of_day(spark, folder):
    rows = ev(spark, folder).where("event_type = 'view'").select("event_id", "user_id", "ts")
    return pattern.first_of_day(rows, USER, ORDER)


@query(
    "daily_uv",
    f"""
    WITH {_FIXED}, d AS (SELECT * FROM fixed WHERE event_type IN ('view', 'signup') {_FIRST_OF_DAY})
    SELECT event_id, user_id, is_new, ts FROM d
    """,
)
def daily_uv(spark, folder):
    is_page = F.col("event_type").isin("view", "signup")
    return jobs.first_visits(_flagged(spark, folder), "user_id", ORDER, "is_new", is_page).select(
        "event_id", "user_id", "is_new", "ts"
    )


@query(
    "running_uv",
    f"""
    WITH d AS (SELECT * FROM events WHERE event_type IN ('view', 'signup') {_FIRST_OF_DAY})
    SELECT 'uv' AS label, user_id, ts, event_id, row_number() OVER (ORDER BY ts, event_id) AS uv FROM d
    """,
)
def running_uv(spark, folder):
    is_page = F.col("event_type").isin("view", "signup")
    return jobs.daily_uv(_flagged(spark, folder), "user_id", ORDER, "is_new", is_page)


# Per (user, item type) and UTC+8 day; the cap is low so that the test tables reach it.
_CAP = 3
_RANKED = f"""
    {EV}, c AS (SELECT *, CAST(ts + INTERVAL 8 HOUR AS DATE) AS day FROM ev),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY ts, event_id) AS rn FROM c)
"""


def _capped(spark, folder):
    return pattern.cap_per_day(ev(spark, folder), ["user_id", "event_type"], ORDER, _CAP, "Asia/Shanghai")


@query("click_cap", f"WITH {_RANKED} SELECT event_id, user_id, event_type, ts FROM r WHERE rn <= {_CAP}")
def click_cap(spark, folder):
    return _capped(spark, folder)[0].select("event_id", "user_id", "event_type", "ts")


@query(
    "click_cap_warnings",
    f"""
    WITH {_RANKED} SELECT user_id, event_type, day, 'click over {_CAP} times.' AS warning_msg FROM r
    WHERE rn = {_CAP + 1}
    """,
)
def click_cap_warnings(spark, folder):
    return _capped(spark, folder)[1]


@query(
    "province_clicks",
    f"""
    WITH {_RANKED}, h AS (SELECT 'p' || CAST(user_id % 8 AS VARCHAR) AS province,
        time_bucket(INTERVAL '5 minutes', ts) + (i * INTERVAL '5 minutes') AS window_end
        FROM r, (SELECT unnest(generate_series(1, 12)) AS i) WHERE rn <= {_CAP})
    SELECT province, window_end, count(*) AS cnt FROM h GROUP BY ALL
    """,
)
def province_clicks(spark, folder):
    clicks = ev(spark, folder).withColumn("province", F.concat(F.lit("p"), F.pmod("user_id", F.lit(8))))
    return jobs.province_clicks(clicks, ["user_id", "event_type"], ORDER, "province", _CAP, "Asia/Shanghai")[0]


@query(
    "repeat_fail_pair",
    """
    SELECT user_id, event_id, prev_ts AS first_ts, ts AS last_ts FROM (SELECT *, lag(ts) OVER w AS prev_ts,
    lag(event_type) OVER w AS prev_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE event_type = 'error' AND prev_type = 'error' AND ts - prev_ts <= INTERVAL 2 HOUR
    """,
)
def repeat_fail_pair(spark, folder):
    out = pattern.consecutive(ev(spark, folder), USER, ORDER, F.col("event_type") == "error", 2, "2 hours")
    return out.select("user_id", "event_id", "first_ts", "last_ts")


@query(
    "repeat_fail_n",
    """
    SELECT user_id, event_id, first_ts, ts AS last_ts FROM (SELECT *, lag(ts, 2) OVER w AS first_ts,
    lag(event_type) OVER w AS t1, lag(event_type, 2) OVER w AS t2 FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE event_type = 'error' AND t1 = 'error' AND t2 = 'error' AND ts - first_ts < INTERVAL 24 HOUR
    """,
)
def repeat_fail_n(spark, folder):
    failed = F.col("event_type") == "error"
    out = pattern.consecutive(ev(spark, folder), USER, ORDER, failed, 3, "24 hours", inclusive=False)
    return out.select("user_id", "event_id", "first_ts", "last_ts")


@query(
    "strict_sequence",
    """
    SELECT user_id, event_id, ts AS first_ts, last_ts FROM (SELECT *, lead(ts, 2) OVER w AS last_ts,
    lead(event_type) OVER w AS t1, lead(event_type, 2) OVER w AS t2 FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE event_type = 'view' AND t1 = 'click' AND t2 = 'purchase' AND last_ts - ts < INTERVAL 48 HOUR
    """,
)
def strict_sequence(spark, folder):
    steps = [F.col("event_type") == kind for kind in ("view", "click", "purchase")]
    out = pattern.sequence(ev(spark, folder), USER, ORDER, steps, "48 hours")
    return out.select("user_id", "event_id", "first_ts", "last_ts")


_STEPS = """
    WITH m AS (SELECT *, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    e AS (SELECT *, min(CASE WHEN event_type = 'error' THEN n END) OVER (PARTITION BY user_id ORDER BY n
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS error_n FROM m)
    SELECT s.user_id, s.event_id, s.ts AS first_ts, b.ts AS error_ts, c.ts AS last_ts FROM e s
    JOIN e a ON a.user_id = s.user_id AND a.n = s.error_n JOIN e b ON b.user_id = s.user_id AND b.n = a.error_n
    JOIN e c ON c.user_id = s.user_id AND c.n = b.n + 1
    WHERE s.event_type = 'signup' AND c.event_type = 'purchase' AND c.ts - s.ts < INTERVAL 7 DAY
"""


def pattern_of_steps():
    """A signup, later two errors, and a purchase right after the second."""
    kind = F.col("event_type")
    return [pattern.Step(kind == "signup"), pattern.Step(kind == "error", 2), pattern.Step(kind == "purchase", strict=True)]


def step_times(matches):
    picked = {"first_ts": 1, "error_ts": 3, "last_ts": 4}
    return matches.select("user_id", "event_id", *[from_us(F.element_at("at", i)).cast("timestamp_ntz").alias(c) for c, i in picked.items()])


@query("match_steps", _STEPS)
def match_steps(spark, folder):
    return step_times(pattern.match_steps(ev(spark, folder), USER, ORDER, pattern_of_steps(), "7 days"))


@query(
    "followed_by_timeout",
    """
    WITH n AS (SELECT *, min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM events),
    o AS (SELECT user_id, event_id, ts, CASE WHEN nxt < ts + INTERVAL 24 HOUR THEN nxt END AS then_ts,
        ts + INTERVAL 24 HOUR AS deadline FROM n WHERE event_type = 'signup')
    SELECT *, CASE WHEN then_ts IS NULL THEN 'timeout' ELSE 'matched' END AS status FROM o
    WHERE then_ts IS NOT NULL OR deadline <= (SELECT max(ts) FROM events)
    """,
)
def followed_by_timeout(spark, folder):
    rows = ev(spark, folder).select("user_id", "event_id", "ts", "event_type")
    create, pay = F.col("event_type") == "signup", F.col("event_type") == "purchase"
    return pattern.followed_by(rows, USER, ORDER, create, pay, "24 hours").drop("event_type")


_OUTCOME = """
    CASE WHEN create_ts IS NULL THEN 'paid_without_create' WHEN pay_ts IS NULL THEN 'never_paid'
    WHEN pay_ts < create_ts + INTERVAL 24 HOUR THEN 'paid' ELSE 'paid_late' END AS result_state
"""


_WAIT = 24 * 3_600_000
# Step by step through an order's rows: due timer, row, new timer.
_OUTCOMES = f"""
WITH RECURSIVE m AS (SELECT user_id, epoch_us(ts) // 1000 AS t, event_type = 'signup' AS made,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, count(*) OVER (PARTITION BY user_id) AS total
    FROM events WHERE event_type IN ('signup', 'purchase')),
s AS (SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS timer, false AS paid,
        CAST(NULL AS VARCHAR) AS timed_out, CAST(NULL AS VARCHAR) AS done FROM m
    UNION ALL SELECT user_id, n, CASE WHEN made AND NOT paid THEN t + {_WAIT} WHEN NOT made AND (timer IS NULL OR paid) THEN t END,
        NOT made AND (timer IS NULL OR paid), timed_out,
        CASE WHEN made AND paid THEN 'paid' WHEN NOT made AND timer IS NOT NULL AND NOT paid
            THEN CASE WHEN t < timer THEN 'paid' ELSE 'paid_late' END END
    FROM (SELECT user_id, n, t, made, CASE WHEN NOT fired THEN timer END AS timer, paid AND NOT fired AS paid,
        CASE WHEN fired THEN CASE WHEN paid THEN 'paid_without_create' ELSE 'never_paid' END END AS timed_out
        FROM (SELECT m.*, s.timer, s.paid, coalesce(s.timer < m.t, false) AS fired
            FROM s JOIN m ON s.user_id = m.user_id AND m.n = s.n + 1)))
SELECT user_id, timed_out AS result_state FROM s WHERE timed_out IS NOT NULL
UNION ALL SELECT user_id, done FROM s WHERE done IS NOT NULL
UNION ALL SELECT s.user_id, CASE WHEN s.paid THEN 'paid_without_create' ELSE 'never_paid' END
    FROM s JOIN m ON s.user_id = m.user_id AND s.n = m.n AND m.n = m.total
    WHERE s.timer IS NOT NULL
"""


@query("order_outcome", _OUTCOMES)
def order_outcome(spark, folder):
    create, pay = F.col("event_type") == "signup", F.col("event_type") == "purchase"
    return pattern.order_outcome(ev(spark, folder), USER, ORDER, create, pay, "24 hours")


@query(
    "order_outcome_first",
    f"""
    WITH t AS (SELECT user_id, min(CASE WHEN event_type = 'signup' THEN ts END) AS create_ts,
        min(CASE WHEN event_type = 'purchase' THEN ts END) AS pay_ts FROM events GROUP BY user_id)
    SELECT *, {_OUTCOME} FROM t WHERE create_ts IS NOT NULL OR pay_ts IS NOT NULL
    """,
)
def order_outcome_first(spark, folder):
    create, pay = F.col("event_type") == "signup", F.col("event_type") == "purchase"
    return pattern.first_outcome(ev(spark, folder), "user_id", "ts", create, pay, "24 hours")


@query(
    "order_outcome_shipping",
    f"""
    WITH a AS (SELECT o_orderkey AS orderkey, o_orderdate AS create_ts, NULL AS pay_ts FROM orders
        UNION ALL SELECT l_orderkey, NULL, l_shipdate FROM lineitem),
    t AS (SELECT orderkey, min(create_ts) AS create_ts, min(pay_ts) AS pay_ts FROM a GROUP BY orderkey)
    SELECT *, {_OUTCOME} FROM t
    """,
)
def order_outcome_shipping(spark, folder):
    made = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_orderdate").alias("ts"), F.lit("create").alias("kind")
    )
    sent = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_shipdate").alias("ts"), F.lit("pay").alias("kind")
    )
    rows = made.unionByName(sent)
    return pattern.first_outcome(rows, "orderkey", "ts", F.col("kind") == "create", F.col("kind") == "pay", "24 hours")


@query(
    "wm_marker",
    f"""
    WITH {_ARRIVALS}, w AS (SELECT *, max(CASE WHEN event_type = 'view' THEN ts END) OVER (ORDER BY arrival, event_id)
        - INTERVAL '60 seconds' AS watermark FROM arr)
    SELECT event_id, ts, watermark, coalesce(ts < watermark, false) AS is_late FROM w
    """,
)
def wm_marker(spark, folder):
    rows = arrivals(ev(spark, folder))
    out = eventtime.late_flags(rows, ["arrival", "event_id"], "ts", "60 seconds", F.col("event_type") == "view")
    return out.select("event_id", "ts", "watermark", "is_late")


@query("wm_table", "SELECT event_id, date_trunc('second', ts) AS rt FROM events")
def wm_table(spark, folder):
    seconds = ev(spark, folder).select("event_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("s"))
    return eventtime.with_event_time(seconds, "rt", "1 second", F.timestamp_seconds("s")).drop("s")
