"""What must hold of the physical plans at scale."""

import pytest
from pyspark.sql import functions as F

from streamtab.catalog import QUERIES
from streamtab.catalog.base import ev
from streamtab.operators import aggregate, over

FOLDER = "/root/testdata/sf0.001"
BATCH = [n for n in QUERIES if not n.startswith(("stream_", "wm_", "allowed_"))]


def plan_of(df, capsys) -> str:
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join(spark, capsys, name):
    plan = plan_of(QUERIES[name](spark, FOLDER), capsys)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filter_and_columns_reach_the_scan(spark, capsys):
    plan = plan_of(QUERIES["select_where"](spark, FOLDER), capsys)
    assert "EqualTo(event_type,view)" in plan and "props" not in plan.split("ReadSchema")[1].splitlines()[0]


def test_counts_are_combined_before_the_shuffle(spark, capsys):
    plan = plan_of(aggregate.preagg_count(ev(spark, FOLDER), ["event_type"]), capsys)
    assert "partial_count" in plan and plan.count("HashAggregate") >= 2


def test_top_n_is_cut_before_the_shuffle(spark, capsys):
    plan = plan_of(over.top_n(ev(spark, FOLDER), ["event_type"], [F.col("value").desc(), F.col("event_id")], 5), capsys)
    assert plan.count("WindowGroupLimit") >= 2
