import random

import numpy as np
import pytest

from streamtab.llm import minhash
from tests.llm.helpers import listed, nothing, odd
from tests.llm.test_partenum import brute as components


def brute(docs, n=5, percent=85):
    """(id, size, component, kept) by comparing all pairs of sets."""
    return [(key, size, least, key == least) for key, size, least in components(docs, percent, n)]


def result(spark, df, **options):
    return listed(minhash.near_copies(spark, df, **options).select("doc_id", "n_shingles", "component_id", "kept"))


def families(seed):
    """Documents of several lengths with copies, edits around the threshold and one passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage, docs, key = rng.choices(vocabulary, k=40), [], 0
    for family in range(10):
        base = rng.choices(vocabulary, k=rng.choice([3, 8, 20, 60, 160, 300]))
        if family % 2:
            base = passage + base
        for copy in range(12):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4]) if copy else 0):
                place = rng.randrange(len(text))
                text[place : place + 1] = rng.choice([[], ["new%d" % rng.randrange(9)], [text[place], "more"]])
            docs.append((key, " ".join(text) if copy % 3 else " ".join(text).upper()))
            key += 1
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("block", [2048, 4])
def test_components_against_brute_force(spark, block):
    docs = families(3)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert result(spark, df, block=block) == brute(docs)


def test_other_shingle_and_threshold(spark):
    docs = families(4)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(spark, df, n=3, percent=70) == brute(docs, 3, 70)


def test_odd_rows(spark):
    df = odd(spark, "class", "bands", "label", "bucket", "id")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = [(k, s, k if not s else c) for k, s, c in components(docs, 85, 5)]
    assert result(spark, df) == sorted(((k, s, c, k == c) for k, s, c in want), key=repr)
    assert minhash.near_copies(spark, nothing(spark)).collect() == []


def test_linked_pairs_pass_the_signature_test():
    rng = np.random.default_rng(1)
    enough = minhash.least_equal()
    assert 70 < enough < 95
    for size in (7, 40, 400, 5000):
        for _ in range(20):
            common = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            apart = int(size * 15 / 85)
            a, b = (np.unique(np.concatenate([common, x])) for x in np.split(rng.integers(0, 1 << 63, 2 * (apart // 2), dtype=np.uint64), 2))
            assert minhash.linked(a, b)
            assert minhash.may_link((len(a), len(b)), (minhash.sketch(a), minhash.sketch(b)))
            x, y = minhash.minima([a, b])
            assert (x == y).sum() >= enough
            assert (minhash.bands(np.stack([x]))[0] == minhash.bands(np.stack([y]))[0]).any()


def test_minima_are_those_of_a_plain_loop():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 3, 50_000, 2)]
    factors, addends = minhash.hash_family()
    for values, row in zip(sets, minhash.minima(sets)):
        for j in (0, 1, 127):
            assert int(row[j]) == min(((int(x) >> 32) * int(factors[j]) + int(addends[j])) % 2**64 for x in values) >> 32


def test_stars(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    want = sorted((x, find(x)) for x in list(root))
    got = minhash.star_components(spark, spark.createDataFrame(edges, "a long, b long"))
    assert sorted(tuple(r) for r in got.collect()) == want
    assert minhash.star_components(spark, spark.createDataFrame([], "a long, b long")).collect() == []
