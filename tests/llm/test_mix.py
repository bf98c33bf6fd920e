import random
from collections import Counter
from itertools import product

import pytest

from streamtab.llm import mix
from streamtab.llm.common import words
from tests.llm.helpers import nothing, odd


@pytest.mark.parametrize("seed", range(30))
def test_fit_budget_is_as_near_as_can_be(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(0, 30), rng.randrange(1, 5)))
    counts = [rng.randrange(1, 4) for _ in lengths]
    budget = rng.randrange(0, sum(n * c for n, c in zip(lengths, counts)) + 5)
    taken = mix.fit_budget(lengths, counts, budget)
    assert all(0 <= t <= c for t, c in zip(taken, counts))
    got = sum(n * t for n, t in zip(lengths, taken))
    best = max(s for s in (sum(n * k for n, k in zip(lengths, pick)) for pick in product(*(range(c + 1) for c in counts))) if s <= budget)
    assert got <= budget and budget - got <= budget - best + 2 * max(lengths)
    if budget <= 2 * max(lengths):
        assert got == best


def targets(sizes):
    """Dealing in rounds: by weight, capped at twice the size, the excess dealt again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, fixed, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return fixed | {s: left * weight[s] / total for s in open_}
        for s in over:
            fixed[s] = 2.0 * sizes[s]
        left -= sum(fixed[s] for s in over)
        open_ -= over
    return fixed


def check(rows, docs):
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(words(text))
    want = targets(sizes)
    taken = Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    longest = Counter()
    for _, text, source in docs:
        longest[source] = max(longest[source], len(words(text)))
    for source, goal in want.items():
        assert abs(taken[source] - goal) <= longest[source]


def test_targets_and_reruns(spark):
    rng = random.Random(2)
    docs = [(i, "w " * rng.randrange(0, 60), rng.choice(["a", "b", "é", "c", None, "big", "big", "big", "big"])) for i in range(900)]
    docs += [(1000 + i, "same size here", "big") for i in range(1500)]
    a = mix.mix(spark, spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)).collect()
    b = mix.mix(spark, spark.createDataFrame(docs[::-1], "doc_id long, text string, source string").repartition(5)).collect()
    assert len(a) == len(docs)
    check(a, docs)
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_odd_rows(spark):
    df = odd(spark, "target", "bucket", "times", "id")
    docs = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
    rows = mix.mix(spark, df).collect()
    assert len(rows) == len(docs)
    check(rows, docs)
    assert mix.mix(spark, nothing(spark)).count() == 0
    copies = mix.mixed_rows(spark, df)
    assert copies.columns == df.columns
    assert copies.count() == sum(r["times"] for r in rows)
    assert mix.mixed_rows(spark, nothing(spark)).count() == 0


def test_a_budget_out_of_reach_takes_little_memory():
    import tracemalloc

    lengths = [*range(2, 4002, 2), 200_000]
    tracemalloc.start()
    taken = mix.fit_budget(lengths, [1] * len(lengths), sum(lengths) // 2 - 1 | 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(n * k for n, k in zip(lengths, taken)) == (sum(lengths) // 2 - 1 | 1) - 1
    assert peak < 20 << 20
