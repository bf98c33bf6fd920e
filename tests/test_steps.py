"""Step patterns against a plain walk, the single-purpose operators, and their stream machine."""

import random

import pytest
from pyspark.sql import functions as F

from streamtab.operators import pattern
from streamtab.streaming import machines
from tests.conftest import rows
from tests.test_patterns import at, timeline


def being(kind):
    return F.col("v") == kind


KEY, ORDER = ["k"], ["ts", "event_id"]


def made(spark, seed, n=120, kinds="abc"):
    rng = random.Random(seed)
    return [(rng.choice("xyz"), rng.randrange(150), rng.choice(kinds)) for _ in range(n)]


def brute(data, steps, within, inclusive):
    """Each opening row by itself; steps are (kind, times, strict)."""
    flat = [(kind, strict) for kind, times, strict in steps for _ in range(times)]
    data = [(k, s, i, v) for i, (k, s, v) in enumerate(sorted(data, key=lambda r: r[1]))]
    out = []
    for key in {r[0] for r in data}:
        own = [r for r in data if r[0] == key]
        for i, first in enumerate(own):
            if first[3] != flat[0][0]:
                continue
            found, j = [first], i
            for kind, strict in flat[1:]:
                j += 1
                while j < len(own) and own[j][3] != kind and not strict:
                    j += 1
                if j >= len(own) or own[j][3] != kind:
                    break
                found.append(own[j])
            took = found[-1][1] - first[1]
            if len(found) == len(flat) and (took < within or inclusive and took == within):
                out.append((key, first[2], [f[1] for f in found]))
    return sorted(out, key=repr)


def seconds(matches):
    base = int((at(0) - at(0).__class__(1970, 1, 1)).total_seconds())
    return sorted(((r["k"], r["event_id"], [t // 1_000_000 - base for t in r["at"]]) for r in matches.collect()), key=repr)


@pytest.mark.parametrize(
    "steps,hot",
    [
        ([("a", 1, False), ("b", 1, False), ("c", 1, False)], None),
        ([("a", 2, True), ("b", 1, False)], None),
        ([("a", 1, False), ("b", 2, False), ("c", 1, True)], 20),
        ([("a", 3, False)], None),
    ],
)
def test_against_a_plain_walk(spark, steps, hot):
    data = made(spark, len(steps))
    df = timeline(spark, data)
    own = [pattern.Step(being(kind), times, strict) for kind, times, strict in steps]
    if hot:
        spark.conf.set("streamtab.hotKeyRows", str(hot))
        spark.conf.set("streamtab.chunkRows", "8")
    try:
        for inclusive in (False, True):
            want = brute(data, steps, 20, inclusive)
            assert want and seconds(pattern.match_steps(df, KEY, ORDER, own, "20 seconds", inclusive)) == want
            # The machine over a table, in the same order.
            assert seconds(machines.match_steps(df, KEY, ORDER, own, "20 seconds", inclusive)) == want
    finally:
        spark.conf.unset("streamtab.hotKeyRows")
        spark.conf.unset("streamtab.chunkRows")


def test_single_purpose_operators_are_patterns(spark):
    df = timeline(spark, made(spark, 9))
    run = pattern.consecutive(df, KEY, ORDER, being("a"), 3, "30 seconds")
    times = pattern.match_steps(df, KEY, ORDER, [pattern.Step(being("a"), 3, True)], "30 seconds", inclusive=True)
    micros = [F.unix_micros(F.col(c).cast("timestamp")) for c in ("first_ts", "last_ts")]
    assert rows(run.select("k", *micros)) == rows(times.select("k", F.col("at")[0], F.col("at")[2])) != []
    strict = pattern.sequence(df, KEY, ORDER, [being("a"), being("b"), being("c")], "30 seconds")
    steps = pattern.match_steps(df, KEY, ORDER, [pattern.Step(being(x), strict=True) for x in "abc"], "30 seconds")
    assert rows(strict.select("k", "event_id", micros[1])) == rows(steps.select("k", "event_id", F.col("at")[2])) != []
    pairs = pattern.followed_by(df, KEY, ORDER, being("a"), being("b"), "9 seconds").where("status = 'matched'")
    both = pattern.match_steps(df, KEY, ORDER, [pattern.Step(being("a")), pattern.Step(being("b"))], "9 seconds")
    then = F.unix_micros(F.col("then_ts").cast("timestamp"))
    assert rows(pairs.select("k", "event_id", then)) == rows(both.select("k", "event_id", F.col("at")[1])) != []


def test_nulls_and_nothing(spark):
    df = timeline(spark, [("a", 1, "a"), (None, 2, "a"), (None, 3, "b"), ("a", 4, None), ("a", 5, "b")])
    steps = [pattern.Step(being("a")), pattern.Step(being("b"))]
    df = df.withColumn("ts", F.when(F.col("event_id") != 4, F.col("ts")))
    assert rows(pattern.match_steps(df, KEY, ORDER, steps, "1 minute").select("k", "event_id")) == [(None, 1)]
    assert pattern.match_steps(df.limit(0), KEY, ORDER, steps, "1 minute").count() == 0
