"""Time the headline queries and the four simple-against-scale pairs. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3, median is reported),
BENCH_ONLY (names to run), BENCH_SLOW=1 (also the naive form of the 5-second slide, about 100 s).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from streamtab.catalog import QUERIES
from streamtab.catalog.base import ev
from streamtab.operators import aggregate, windows
from streamtab.operators.scan import running_count
from streamtab.session import get_session

HEADLINE = (
    "word_count rolling_sum rolling_max_by tumbling_count sliding_count hot_items hot_pages channel_counts session_window "
    "count_slide_avg hourly_uv hourly_uv_bitmap hourly_uv_running interval_join interval_join_orders match_or_report "
    "top2_per_key jump_alert repeat_fail_n fail_burst rising_alert followed_by_timeout order_outcome_shipping click_cap "
    "daily_uv cdc_current cdc_retract split_late parse_app_log distinct_count_case stream_hot_items stream_running_count"
).split()

COUNT = {"cnt": ("count", "*")}


def _slide(step, strategy):
    return lambda s, d: windows.slide(ev(s, d), "ts", "1 hour", step, [], COUNT, strategy)


def _skewed(s, d):
    """80 % of the rows on one key."""
    return ev(s, d).withColumn("key", F.when(F.pmod("event_id", F.lit(10)) < 8, "hot").otherwise(F.col("user_id").cast("string")))


PAIRS = {
    "slide_1h_5s_simple": _slide("5 seconds", "expand"),
    "slide_1h_5s_panes": _slide("5 seconds", "panes"),
    "slide_1h_1s_panes": _slide("1 second", "panes"),
    "skew_window_simple": lambda s, d: windows.tumble(_skewed(s, d), "ts", "10 seconds", ["key"], {"cnt": F.count("*")}),
    "skew_window_salted": lambda s, d: aggregate.salted_window_count(_skewed(s, d), "ts", ["key"], "10 seconds", "event_id"),
    "skew_distinct_simple": lambda s, d: aggregate.distinct_counts(_skewed(s, d), ["key"], {"cnt": ("user_id", None)}),
    "skew_distinct_split": lambda s, d: aggregate.split_count_distinct(_skewed(s, d), ["key"], "user_id"),
    "running_total_simple": lambda s, d: ev(s, d).select("event_id", F.row_number().over(Window.orderBy("ts", "event_id")).alias("n")),
    "running_total_scan": lambda s, d: running_count(ev(s, d).select("ts", "event_id"), ["ts", "event_id"]),
}

SLOW = {"slide_1h_5s_simple"}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = os.environ.get("BENCH_ONLY", "").split()
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")

    def timed(fn) -> float:
        start = time.perf_counter()
        fn(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    def measure(name, fn) -> float:
        once = name.startswith("stream_") or name in SLOW
        if not once:
            timed(fn)
        return round(statistics.median(timed(fn) for _ in range(1 if once else runs)), 3)

    timings = {n: measure(n, QUERIES[n]) for n in HEADLINE if not only or n in only}
    slow = os.environ.get("BENCH_SLOW") == "1"
    pairs = {n: measure(n, fn) for n, fn in PAIRS.items() if (n in only if only else slow or n not in SLOW)}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "pairs": pairs,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "spark": spark.version,
                "cores": cpus,
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
