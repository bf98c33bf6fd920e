import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from streamtab.llm import spelling
from tests.llm.helpers import listed, nothing, odd

LETTERS = "abcdetsnoirlmuáéüÀ÷z"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def brute(docs):
    """From the rule: every run by itself, and every pair of words."""
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            check = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if check % 199 == 0:
                place = check % len(run)
                run = run[:place] + run[place + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    deleted = {}
    for w in words:
        for i in range(len(w)):
            deleted.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    form, rows = {}, {}
    for w, n in words.items():
        # Near words share a deletion, or one is a deletion of the other.
        some = set(deleted.get(w, ())).union(*({w[:i] + w[i + 1 :]} & set(words) | deleted[w[:i] + w[i + 1 :]] for i in range(len(w))))
        others = [(-words[x], x) for x in some if distance(w, x) == 1]
        best = min(others, default=None)
        form[w] = best[1] if best and -best[0] >= 5 * n else None
        rows[w] = (n, len(others))
    out = []
    for w, (n, k) in rows.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, k, words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def result(spark, df, **options):
    return listed(spelling.group_spellings(spark, df, **options).select("word", "form", "root", "n", "n_near", "form_n"))


@settings(max_examples=400, deadline=None)
@given(st.text(LETTERS, min_size=1, max_size=9), st.text(LETTERS, min_size=1, max_size=9), st.integers(0, 9), st.sampled_from(LETTERS))
def test_near_and_reach(a, b, place, letter):
    place = min(place, len(a) - 1)
    for other in (b, a, a[:place] + a[place + 1 :], a[:place] + letter + a[place:], a[:place] + letter + a[place + 1 :]):
        assert spelling.near(a, other) == (distance(a, other) == 1)
        if spelling.near(a, other) and other:
            # One of the two asks, in the whole trie and in the one subtree that it is sent to.
            for depth in (0, spelling.TOP):
                hits = []
                for word, stored in ((a, other), (other, a)):
                    counts, kept = spelling.vector(word), spelling.vector(stored)
                    routes = [s for cell, s in spelling.reachable(counts[:depth]) if cell == kept[:depth]]
                    assert len(routes) <= 1
                    trie = spelling.Trie(depth)
                    trie.add(kept, stored, 1)
                    hits += [hit for s in routes for hit in trie.near(counts, s, word)]
                assert len(hits) == 1


def corpus(seed):
    rng = random.Random(seed)
    def variant(w):
        place = rng.randrange(len(w))
        return rng.choice([w[:place] + w[place + 1 :], w[:place] + rng.choice(LETTERS) + w[place:], w[:place] + rng.choice(LETTERS) + w[place + 1 :]])

    words, weights = [], []
    for _ in range(40):
        base = "".join(rng.choices(LETTERS, k=rng.choice([5, 6, 7, 9, 14])))
        once = [variant(base) for _ in range(3)]
        words += [base, *once, *[variant(w) for w in once]]
        weights += [600, *[rng.choice([100, 600]) for _ in once], *[15 for _ in once]]
    return [(i, " ".join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(words, weights, k=rng.choice([5, 80, 900])))) for i in range(80)]


@pytest.mark.parametrize("piece", [1 << 14, 3])
def test_against_brute_force(spark, piece):
    docs = corpus(1)
    want = brute(docs)
    assert any(f for _, f, *_ in want) and any(r != f and f for _, f, r, *_ in want)
    assert result(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3), piece=piece) == want


def test_odd_rows(spark):
    long = "q" * 400
    rows = [(9, " ".join([long] * 5 + [long + "q"] * 30 + [long + "e"] * 6), "s", 1)] * 2
    df = odd(spark, "word", "n", "root", "id", "cell")
    assert result(spark, df) == brute([(r["doc_id"], r["text"]) for r in df.collect()])
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    assert result(spark, df) == brute([r[:2] for r in rows])
    assert spelling.group_spellings(spark, nothing(spark)).collect() == []
