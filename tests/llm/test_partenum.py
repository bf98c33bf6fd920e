import random
import time
from itertools import combinations

import numpy as np
import pytest

from streamtab.llm import partenum
from streamtab.llm.common import CLEARS, saved, words
from tests.llm.helpers import listed, nothing, odd


@pytest.mark.parametrize("size", [1, 2, 5, 7, 8, 12, 13, 20, 27, 40, 75, 150, 400, 1000])
def test_linked_sets_share_a_signature(size):
    rng = np.random.default_rng(size)
    for trial in range(12):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        most = partenum.most_apart(2 * size)
        drop = int(rng.integers(0, most + 1))
        add = int(rng.integers(0, most - drop + 1))
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)]))
        if len(b) and partenum.linked(a, b) and len(np.setxor1d(a, b)):
            for seed in (0, 1):
                assert np.intersect1d(partenum.signatures(a, seed=seed), partenum.signatures(b, seed=seed)).size
            assert partenum.may_link(len(a), partenum.sketch(a), len(b), partenum.sketch(b))


def sets_of(text, n=4):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def brute(docs, percent=85, n=4):
    sets = [sets_of(t, n) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        out.append((key, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group_rows", [2048, 2])
def test_components_against_brute_force(spark, group_rows):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=25)
    docs, key = [], 0
    for family in range(8):
        base = rng.choices(vocabulary, k=rng.choice([3, 8, 20, 60, 160]))
        if family % 2:
            base = passage + base
        for _ in range(9):
            text = list(base)
            for _ in range(rng.randrange(0, max(1, len(text) // 25) + 1)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            docs.append((key, " ".join(text)))
            key += 1
    docs += [(key, None), (key + 1, ""), (key + 2, "A a"), (key + 3, "a A"), (None, docs[4][1]), (4, docs[4][1]), (None, " \n")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    out = partenum.near_groups(spark, df)
    if group_rows != 2048:
        labels = partenum.class_components(spark, df.select("text"), group_rows=group_rows)
        own = out.select("class", "label").distinct().where("class IS NOT NULL")
        joined = own.alias("o").join(labels.alias("l"), own["class"] == labels["id"], "left").selectExpr("o.label AS a", "coalesce(l.label, class) AS b")
        assert joined.where("a != b").count() == 0
        return
    assert listed(out.select("doc_id", "n_shingles", "component_id")) == brute(docs)


def test_odd_rows(spark):
    got = listed(partenum.near_groups(spark, odd(spark, "class", "label", "id")).select("doc_id", "n_shingles", "component_id"))
    assert (1, 0, 1) in got and (2, 0, 2) in got and (3, 0, 3) in got and (None, 0, None) in got
    assert got.count((4, 1, 4)) == 2 and (None, 1, 4) in got
    assert partenum.near_groups(spark, nothing(spark)).count() == 0


def test_one_of_each(spark):
    df = odd(spark, "label", "times")
    kept = listed(partenum.one_of_each(spark, df))
    assert len(kept) == 4 + 1 + 1
    assert sum(r[1] == "one two three" for r in kept) == 1
    assert partenum.one_of_each(spark, nothing(spark)).count() == 0


def test_whole_sets_are_written_for_candidates_only(spark, monkeypatch):
    """Of what is written, only the sets of pairs whose sketches allow a link hold all shingles; signatures have 40 bits."""
    rng, written, real = random.Random(3), [], partenum.saved

    def saved(spark, df, label, **options):
        out = real(spark, df, label, **options)
        written.append((label, out))
        return out

    monkeypatch.setattr(partenum, "saved", saved)
    base = [f"w{i}" for i in range(400)]
    # Texts with one long passage in common: they share signatures, and are far from linked.
    docs = [(k, " ".join(base[:200] + [f"{k}x{rng.random()}" for _ in range(200)])) for k in range(30)]
    docs += [(100, " ".join(base)), (101, " ".join([*base, "more"]))]
    out = partenum.near_groups(spark, spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {k: min(k, 100) for k, _ in docs}
    sizes = {label: max(df.count() for name, df in written if name == label) for label, _ in written}
    assert sizes["partenum-sets"] > 2 and sizes["partenum-elements"] == 2
    assert {label for label, df in written if "elements" in df.columns} == {"partenum-elements"}
    sigs = next(df for label, df in written if label == "partenum-classes").selectExpr("explode(sigs) AS sig")
    assert sigs.where("sig < 0 OR sig >= 1099511627776").count() == 0 and max(len(partenum.sketch(np.arange(n, dtype=np.uint64))) for n in range(330)) == 64


def near_copies(count, words_each, changed, seed=3):
    """Texts that differ from one text in a few words each, at places of their own."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words_each)]
    out = []
    for i in range(count):
        own = list(base)
        for at in rng.sample(range(words_each), changed):
            own[at] = f"x{i}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("size, percent", [(40, 85), (9, 85)])
def test_rows_of_a_group_grow_with_its_members(spark, size, percent):
    texts = near_copies(size, 400, 5)
    sets = [np.unique(np.array([hash(g) & (1 << 62) - 1 for g in sets_of(t)], np.uint64)) for t in texts]
    assert not any(partenum.linked(a, b, 95) for i, a in enumerate(sets) for b in sets[:i])
    rows = spark.createDataFrame([(1, i, i) for i in range(size)], "sig long, id long, label long")
    made = spark.createDataFrame([(i, len(e), bytearray(partenum.sketch(e))) for i, e in enumerate(sets)], "id long, size long, sketch binary")
    for forest in (True, False):
        found = partenum._across(spark, rows, made, percent, forest).collect()
        assert size - 1 <= len(found) <= 2 * size
        # All that may be linked stay together.
        root = list(range(size))
        for r in found:
            root = [root[r["a"]] if x == root[r["b"]] else x for x in root]
        assert len(set(root)) == 1


@pytest.mark.parametrize("group_rows", [2048, 7])
def test_near_copies_that_are_mostly_apart(spark, group_rows, monkeypatch):
    dense = []
    whole = partenum._dense_links
    monkeypatch.setattr(partenum, "_dense_links", lambda *a: dense.append(1) or whole(*a))
    docs = list(enumerate(near_copies(60, 400, 6) + near_copies(12, 400, 4, seed=8)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = partenum.class_components(spark, df.select("text"), percent=85, group_rows=group_rows)
    made = partenum.classes(df, partenum.SHINGLE, 85).select("doc_id", "class").join(labels.withColumnRenamed("id", "class"), "class", "left")
    found = {}
    for r in made.collect():
        found.setdefault(r["label"] if r["label"] is not None else r["class"], []).append(r["doc_id"])
    expected = {}
    for key, _, component in brute(docs):
        expected.setdefault(component, []).append(key)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))
    assert dense or group_rows < 2048


@pytest.mark.parametrize("size, percent", [(20, 80), (30, 80), (60, 80), (200, 80), (500, 80)])
def test_unlike_sets_share_few_signatures(size, percent):
    """A signature that a fixed share of all sets has would make groups, and pairs, that outgrow the table."""
    rng, times = np.random.default_rng(size), {}
    count = 3000
    for _ in range(count):
        for sig in partenum.signatures(rng.integers(0, 1 << 63, size, dtype=np.uint64), percent).tolist():
            times[sig] = times.get(sig, 0) + 1
    assert sum(n * (n - 1) for n in times.values()) < 0.0005 * count * count
    assert max(times.values()) < 0.005 * count


@pytest.mark.parametrize("percent", [80, 85])
def test_sets_as_far_apart_as_links_may_be_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    for size in [5, 9, 12, 18, 20, 28, 35, 60, 130, 210, 900] * 8:
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        add = int(rng.integers(0, size * (100 - percent) // percent + 1))
        drop = size - -(-percent * (size + add) // 100)
        b = np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)])
        if add + drop:
            assert partenum.linked(a, b, percent) and not partenum.linked(a, b[1:], percent)
            assert np.intersect1d(partenum.signatures(a, percent), partenum.signatures(b, percent)).size


def test_large_groups_are_dealt_and_all_their_members_meet(spark):
    rows = [(1, i, i % 3) for i in range(90)] + [(2, i, i) for i in range(6)] + [(3, i, 7) for i in range(90)]
    out = listed(partenum._divided(spark, spark.createDataFrame(rows, "sig long, id long, label long"), 8))
    groups = {}
    for sig, name, label in out:
        groups.setdefault(sig, []).append((name, label))
    assert sorted(groups.pop(2)) == [(i, i) for i in range(6)] and 3 not in groups
    assert {(a, b) for g in groups.values() for (a, _), (b, _) in combinations(sorted(g), 2)} == set(combinations(range(90), 2))
    assert all(label == name % 3 for g in groups.values() for name, label in g)
    # Each row is in one group for each other part, and parts have four rows.
    assert len(out) - 6 <= 90 * -(-90 // 4)


def test_what_is_saved_leaves_no_shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = lambda: {f for f in files.getAllFiles().mkString("|").split("|") if "shuffle_" in f and f.endswith(".data")}
    before, conf, until = names(), spark.conf.get(CLEARS, None), time.time() + 30
    out = saved(spark, spark.range(20000).selectExpr("id % 7000 AS k").groupBy("k").count().repartition(5, "count"), "test-shuffles")
    while names() - before and time.time() < until:
        time.sleep(0.2)
    assert not names() - before and spark.conf.get(CLEARS, None) == conf
    assert out.count() == 7000
