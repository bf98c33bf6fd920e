"""Sources, parsing and sinks (round trips through the shared scratch folder)."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamtab.catalog.base import EV, ev, query
from streamtab.functions.times import epoch_us
from streamtab.operators.cdc import apply_changes, to_retract
from streamtab.operators.route import tag_rows
from streamtab.operators.scan import lag, run_over
from streamtab.session import scratch_path
from streamtab.sources import broker, files, parse, sinks

_RECORD = "user_id bigint, event_type string, value double, timestamp bigint"
_RECORD_SQL = "SELECT user_id, event_type, value, epoch_us(ts) AS timestamp FROM events"


def _record_lines(spark, folder):
    return ev(spark, folder).select(
        F.concat_ws(",", "user_id", "event_type", F.col("value").cast("string"), epoch_us("ts")).alias("line")
    )


@query("src_text", "SELECT unnest(string_split(text, chr(10))) AS line FROM documents")
def src_text(spark, folder):
    path = scratch_path(spark, "src_text")
    files.table(spark, folder, "documents").select("text").write.text(path)
    return files.read_lines(spark, path)


@query("src_delimited", _RECORD_SQL)
def src_delimited(spark, folder):
    path = scratch_path(spark, "src_delimited")
    _record_lines(spark, folder).write.text(path)
    return parse.parse_delimited(files.read_lines(spark, path), _RECORD)


@query("src_csv_table", "SELECT event_id, ts, user_id, event_type, value FROM events")
def src_csv_table(spark, folder):
    path = scratch_path(spark, "src_csv")
    fmt = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    ev(spark, folder).drop("k").write.options(**fmt).csv(path)
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    return files.csv_table(spark, path, schema, **fmt)


@query(
    "src_collection",
    """
    SELECT e.event_type, CAST(count(*) * w.weight AS BIGINT) AS score FROM events e
    JOIN (VALUES ('signup', 5), ('purchase', 4), ('click', 2), ('view', 1), ('error', 0)) AS w(event_type, weight)
    ON e.event_type = w.event_type GROUP BY e.event_type, w.weight
    """,
)
def src_collection(spark, folder):
    rows = [("signup", 5), ("purchase", 4), ("click", 2), ("view", 1), ("error", 0)]
    weights = files.from_rows(spark, rows, "event_type string, weight int")
    counts = ev(spark, folder).groupBy("event_type").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(weights), "event_type").select(
        "event_type", (F.col("n") * F.col("weight")).alias("score")
    )


@query("src_broker", _RECORD_SQL)
def src_broker(spark, folder):
    raw = _record_lines(spark, folder).select(
        F.lit(None).cast("binary").alias("key"), F.col("line").cast("binary").alias("value"), F.lit("t").alias("topic")
    )
    return broker.decode(raw, _RECORD)


_REQUEST_URL = (
    "concat('/', event_type, '/', k, CASE WHEN k % 10 = 0 THEN '.css' WHEN k % 10 = 1 THEN '.png' ELSE '' END)"
)


def requests(events):
    """Web requests derived from events: url from type and item, POST for sign-ups."""
    return events.withColumns(
        {
            "ip": F.concat(F.lit("10.0.0."), F.pmod("user_id", F.lit(256))),
            "method": F.when(F.col("event_type") == "signup", "POST").otherwise("GET"),
            "url": F.expr(_REQUEST_URL),
        }
    )


def _log_lines(spark, folder):
    return requests(ev(spark, folder)).select(
        F.concat_ws(
            " ", "ip", "user_id", F.lit("-"), F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), "method", "url"
        ).alias("line")
    )


@query(
    "parse_access_log",
    f"""
    WITH {EV} SELECT '10.0.0.' || CAST(user_id % 256 AS VARCHAR) AS ip, CAST(user_id AS VARCHAR) AS user_id,
    date_trunc('second', ts) AS ts, CASE WHEN event_type = 'signup' THEN 'POST' ELSE 'GET' END AS method,
    {_REQUEST_URL} AS url FROM ev
    """,
)
def parse_access_log(spark, folder):
    path = scratch_path(spark, "access_log")
    _log_lines(spark, folder).write.text(path)
    return parse.parse_access_log(files.read_lines(spark, path))


def app_log_json(events):
    """Nested log records derived from events: purchases are start records, the others page records."""
    s = lambda c: F.col(c).cast("string")
    is_start = F.col("event_type") == "purchase"
    common = F.struct(
        s("user_id").alias("mid"),
        s("user_id").alias("uid"),
        F.col("event_type").alias("ch"),
        s("k").alias("ar"),
        F.when(F.col("event_type") == "signup", "1").otherwise("0").alias("is_new"),
    )
    page = F.struct(
        F.when(F.col("event_type") == "click", "home").alias("last_page_id"), F.concat(F.lit("p"), "k").alias("page_id")
    )
    start = F.struct(F.lit("icon").alias("entry"), F.col("k").alias("open_ad_id"))
    actions = F.array(F.struct(F.col("event_type").alias("action_id"), s("k").alias("item")))
    return events.select(
        F.to_json(
            F.struct(
                F.floor(epoch_us("ts") / 1000).alias("ts"),
                common.alias("common"),
                F.when(is_start, start).alias("start"),
                F.when(~is_start, page).alias("page"),
                F.when(~is_start, actions).alias("actions"),
            )
        ).alias("value")
    )


@query(
    "parse_app_log",
    f"""
    WITH {EV} SELECT date_trunc('millisecond', ts) AS ts, CAST(user_id AS VARCHAR) AS mid, event_type AS ch,
    CAST(k AS VARCHAR) AS ar, CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
    CASE WHEN event_type = 'click' THEN 'home' END AS last_page_id,
    CASE WHEN event_type <> 'purchase' THEN 'p' || CAST(k AS VARCHAR) END AS page_id,
    CASE WHEN event_type = 'purchase' THEN k END AS open_ad_id,
    CASE WHEN event_type <> 'purchase' THEN event_type END AS action_id FROM ev
    """,
)
def parse_app_log(spark, folder):
    logs = parse.parse_app_log(app_log_json(ev(spark, folder)))
    return logs.select(
        "ts",
        "common.mid",
        "common.ch",
        "common.ar",
        "common.is_new",
        "page.last_page_id",
        "page.page_id",
        "start.open_ad_id",
        F.get("actions", F.lit(0))["action_id"].alias("action_id"),
    )


def _changes(spark, folder):
    """Row changes derived from events: a user's first row creates, errors delete, the others update."""
    seen = run_over(ev(spark, folder), ["user_id"], ["ts", "event_id"], {"before_value": lag("value")})
    op = F.when(F.col("before_value").isNull(), "CREATE").when(F.col("event_type") == "error", "DELETE")
    return seen.withColumn("op", op.otherwise("UPDATE"))


@query(
    "parse_change_event",
    """
    WITH c AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pv FROM events)
    SELECT event_id, 'shop' AS db, 'accounts' AS table_name, CASE WHEN pv IS NOT NULL THEN user_id END AS before_id,
    pv AS before_value, CASE WHEN pv IS NULL OR event_type <> 'error' THEN user_id END AS after_id,
    CASE WHEN pv IS NULL OR event_type <> 'error' THEN value END AS after_value,
    CASE WHEN pv IS NULL THEN 'create' WHEN event_type = 'error' THEN 'delete' ELSE 'update' END AS op FROM c
    """,
)
def parse_change_event(spark, folder):
    old = F.struct(F.col("user_id").alias("id"), F.col("before_value").alias("value"))
    new = F.struct(F.col("user_id").alias("id"), F.col("value").alias("value"))
    raw = _changes(spark, folder).select(
        "event_id",
        F.lit("mysql.shop.accounts").alias("topic"),
        F.when(F.col("before_value").isNotNull(), F.to_json(old)).alias("before"),
        F.when(F.col("op") != "DELETE", F.to_json(new)).alias("after"),
        "op",
    )
    out = parse.parse_change_event(raw, "id bigint, value double")
    return out.select(
        "event_id",
        "db",
        "table_name",
        F.col("before.id").alias("before_id"),
        F.col("before.value").alias("before_value"),
        F.col("after.id").alias("after_id"),
        F.col("after.value").alias("after_value"),
        "op",
    )


@query(
    "cdc_current",
    f"""
    WITH {EV} SELECT event_id, ts, user_id, event_type, value, k FROM ev
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AND event_type <> 'error'
    """,
)
def cdc_current(spark, folder):
    op = F.when(F.col("event_type") == "error", "d").otherwise("u")
    return apply_changes(ev(spark, folder).withColumn("op", op), ["user_id"], ["ts", "event_id"])


@query(
    "cdc_retract",
    f"""
    WITH {EV}, c AS (SELECT *, lag(event_id) OVER w AS o_id, lag(ts) OVER w AS o_ts, lag(event_type) OVER w AS o_type,
        lag(value) OVER w AS o_value, lag(k) OVER w AS o_k FROM ev
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT ts AS change_ts, event_id AS change_event_id, false AS is_add, o_id AS event_id, o_ts AS ts, user_id,
        o_type AS event_type, o_value AS value, o_k AS k FROM c WHERE o_id IS NOT NULL AND o_type <> 'error'
    UNION ALL SELECT ts, event_id, true, event_id, ts, user_id, event_type, value, k FROM c WHERE event_type <> 'error'
    """,
)
def cdc_retract(spark, folder):
    return to_retract(ev(spark, folder), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")


@query("sink_csv", "SELECT event_id, user_id, value FROM events WHERE value > 20.0")
def sink_csv(spark, folder):
    path = scratch_path(spark, "sink_csv")
    rows = ev(spark, folder).where("value > 20.0").select("event_id", "user_id", "value")
    for part in (0, 1, 1):
        # The second write is replayed.
        sinks.append_csv(rows.where(F.pmod("event_id", F.lit(2)) == part), path, write_id=part)
    return sinks.read_written(spark, path, "event_id bigint, user_id bigint, value double", "csv")


@query(
    "sink_broker",
    f"""
    WITH {EV} SELECT CAST(user_id AS VARCHAR) AS key, concat_ws(',', user_id, event_type, k) AS value
    FROM ev WHERE value > 20.0
    """,
)
def sink_broker(spark, folder):
    rows = ev(spark, folder).where("value > 20.0")
    return broker.to_broker_value(rows, ["user_id", "event_type", "k"], key="user_id")


@query(
    "sink_upsert",
    f"""
    WITH {EV} SELECT user_id, event_id, value FROM ev
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
    """,
)
def sink_upsert(spark, folder):
    """What the database sink stages: the last row per key."""
    return sinks.last_per_key(ev(spark, folder).select("user_id", "event_id", "value"), ["user_id"], ["event_id"])


@query(
    "sink_keyed_latest",
    f"""
    WITH {EV} SELECT event_id, ts, user_id, event_type, value, k FROM ev
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def sink_keyed_latest(spark, folder):
    path = scratch_path(spark, "keyed")
    rows, order = ev(spark, folder), ["ts", "event_id"]
    early = F.col("value") > 20.0
    sinks.upsert_table(rows.where(early), path, ["user_id"], order, batch_id=0)
    sinks.upsert_table(rows.where(~early), path, ["user_id"], order, batch_id=1)
    return sinks.read_latest(spark, path, ["user_id"], order)


@query("sink_documents", "SELECT user_id AS id, value AS temp, epoch_us(ts) AS ts FROM events")
def sink_documents(spark, folder):
    path = scratch_path(spark, "documents")
    rows = ev(spark, folder).withColumn("us", epoch_us("ts"))
    sinks.to_documents(rows, {"id": "user_id", "temp": "value", "ts": "us"}).write.text(path)
    back = spark.read.schema("id string, temp string, ts string").json(path)
    return back.select(F.col("id").cast("bigint"), F.col("temp").cast("double"), F.col("ts").cast("bigint"))


@query("sink_tagged", "SELECT CASE WHEN value > 30.0 THEN 'high' ELSE 'low' END AS tag, event_id, value FROM events")
def sink_tagged(spark, folder):
    path = scratch_path(spark, "tagged")
    rows = tag_rows(ev(spark, folder).select("event_id", "value"), {"high": F.col("value") > 30.0}, "low")
    sinks.write_tagged(rows, path)
    return spark.read.parquet(path).select("tag", "event_id", "value")


@query("sink_tagged_formats", "SELECT CASE WHEN value > 30.0 THEN 'high' ELSE 'low' END AS tag, event_id, value FROM events")
def sink_tagged_formats(spark, folder):
    """A format and a place for each tag."""
    path, schema = scratch_path(spark, "tagged"), "event_id bigint, value double"
    places = {"high": ("csv", f"{path}/high"), "low": ("parquet", f"{path}/low")}
    rows = tag_rows(ev(spark, folder).select("event_id", "value"), {"high": F.col("value") > 30.0}, "low")
    for _ in range(2):
        sinks.write_tags(rows, places, "first")
    high, low = (sinks.read_written(spark, place, schema, fmt).withColumn("tag", F.lit(tag)) for tag, (fmt, place) in places.items())
    return high.unionByName(low).select("tag", "event_id", "value")
