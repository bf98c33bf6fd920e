import hashlib
import math

import numpy as np
import pytest

from streamtab.llm import planes
from tests.llm.helpers import listed

SCHEMA = "vec_id long, embedding array<float>, cluster string"


def brute(rows, clusters=8, rounds=10):
    """Plain lists and whole numbers."""
    kept = [(k, [math.floor(1024 * x) for x in v]) for k, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest()))
    centroids = [v for _, v in order[:clusters]]

    def nearest(v):
        return min((apart(v, c), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(col) // len(groups[i]) for col in zip(*groups[i])] if i in groups else c for i, c in enumerate(centroids)]
    placed = [(k, *nearest(v)[::-1]) for k, v in kept]
    total = sum(d for _, _, d in placed)
    return sorted(((k, c, d, sum(e for _, b, e in placed if b == c), total,
                    hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for k, c, d in placed), key=repr)


@pytest.mark.parametrize("reach", [1, 7, 600, planes.LIMIT - 1])
def test_popcounts_give_the_dot_product(reach):
    rng = np.random.default_rng(reach)
    a, b = rng.integers(-reach, reach + 1, (50, 64)), rng.integers(-reach, reach + 1, (50, 64))
    a[0], b[0] = -reach, reach
    x, y = planes.pack(a).T, planes.pack(b).T
    want = [sum(int(p) * int(q) for p, q in zip(u, v)) for u, v in zip(a, b)]
    assert planes.dot(x, y).tolist() == want
    assert planes.dot(x, y[:, 3]).tolist() == [sum(int(p) * int(q) for p, q in zip(u, b[3])) for u in a]
    assert planes.unpacked_sum(x).tolist() == a.sum(axis=0).tolist()


def vectors(n, seed=1):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 0.3, (5, 64))
    return [(i, (middles[i % 5] + rng.normal(0, 0.1, 64)).astype(np.float32).tolist()) for i in range(n)]


def test_against_brute_force(spark):
    rows = vectors(300)
    rows[7] = (7, [40.0] + rows[7][1][1:])
    odd = [(900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 65), (904, [float("nan")] + [0.0] * 63), (905, [float("inf")] + [0.0] * 63),
           (906, [None] + [0.0] * 63), (None, [0.25] * 64), (3, rows[3][1]), (3, rows[3][1]), (907, [0.0] * 64), (908, [-0.0] * 64)]
    df = spark.createDataFrame([(k, v, "kept") for k, v in rows + odd], SCHEMA)
    want = brute(rows + odd)
    assert listed(planes.cluster_vectors(spark, df)) == want
    assert listed(planes.cluster_vectors(spark, df.repartition(1))) == want


def test_few_vectors_and_ties(spark):
    rows = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.5] * 64)]
    df = spark.createDataFrame([(k, v, "") for k, v in rows], SCHEMA)
    assert listed(planes.cluster_vectors(spark, df)) == brute(rows)
    assert planes.cluster_vectors(spark, df.limit(0)).collect() == []


def test_values_that_do_not_fit():
    with pytest.raises(ValueError):
        planes.whole(np.full((1, 64), 2.0**40))
