import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from streamtab.llm import decontam as dc
from tests.llm.helpers import listed, nothing, odd


def plain(item, passage):
    rows = [[0] * (len(passage) + 1)]
    for x in item:
        row = [0]
        for j, y in enumerate(passage):
            row.append(max(0, rows[-1][j] + (dc.MATCH if x == y else dc.MISMATCH), rows[-1][j + 1] + dc.GAP, row[j] + dc.GAP))
        rows.append(row)
    return max(map(max, rows))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=15))
def test_align(item, passage):
    score, first, last = dc.align(np.array(item, np.uint64), np.array(passage, np.uint64))
    assert score == plain(item, passage)
    if score:
        assert plain(item, passage[first : last + 1]) == score


def test_edited_copies_are_found_and_clean_documents_left(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    items = [(i, [word() for _ in range(25)]) for i in range(6)]
    docs, want = [], set()
    for key in range(60):
        text = [word() for _ in range(80)]
        if key % 3 == 0:
            item, copy = items[key // 3 % 6]
            copy = list(copy)
            for at in rng.sample(range(25), 3):
                copy[at] = word()
            if key % 2:
                copy.insert(7, word())
                del copy[15]
            text[40:40] = [w.upper() + "," for w in copy]
            want.add((key, item))
        docs.append((key, " ".join(text)))
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = dc.find_copies(spark, d, b).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert {r["doc_id"] for r in dc.without_copies(spark, d, b).collect()} == {k for k, _ in docs} - {k for k, _ in want}


def test_an_item_in_most_documents_is_still_found(spark):
    rng = random.Random(4)
    item = " ".join("".join(rng.choices("klmnop", k=6)) for _ in range(20))
    d = spark.createDataFrame([(i, f"before {item} after {i}") for i in range(40)], "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert dc.find_copies(spark, d, b).count() == 40


def test_odd_rows(spark):
    b = spark.createDataFrame([(1, "one two three", "x"), (1, "One, two three!", "x"), (2, None, "x"), (3, "", "x"), (None, "one two three", "x"), (4, "two", "x")],
                              "item_id long, text string, doc_id string")
    got = listed(dc.find_copies(spark, odd(spark, "item_id", "score"), b).select("doc_id", "item_id"))
    assert got.count((4, 1)) >= 2 and (None, 1) in got and (4, 4) in got
    assert {r[1] for r in got} == {1, 4}
    assert dc.find_copies(spark, nothing(spark), b).count() == 0
    assert dc.find_copies(spark, odd(spark), b.where("false")).count() == 0
    assert listed(dc.without_copies(spark, odd(spark, "score"), b).select("doc_id")) == [(1,), (2,), (3,), (5,), (None,)]


def test_every_passage_that_scores_is_found(spark):
    """Against Smith-Waterman over whole documents: words replaced at 20 to 33 %, words put in, half quotes, items that leaked often."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    common = ["the", "of", "and", "to"]
    items = [(i, [rng.choice(common) if rng.random() < 0.3 else word() for _ in range(40)]) for i in range(4)]
    texts = []
    for _, own in items:
        for step in (3, 4, 5):
            texts.append([word() if at % step == 2 else w for at, w in enumerate(own)])
        for share in (0.2, 0.25, 0.3, 0.4):
            texts.append([word() if rng.random() < share else w for w in own])
        texts += [own[:20], own[20:], own[:19], own[10:31], [x for w in own for x in (w, word())], list(own), list(own)]
        texts.append([x for w in own[:30] for x in (w, rng.choice(common))])
    docs = []
    for key, copy in enumerate(texts):
        pad = [rng.choice(common) if rng.random() < 0.5 else word() for _ in range(120)]
        docs.append((key, pad[:60] + copy + pad[60:]))
    want = {}
    for key, text in docs:
        for i, own in items:
            score = plain(own, text) / (dc.MATCH * len(own))
            if score >= dc.MIN_SCORE:
                want[(key, i)] = score
    d = spark.createDataFrame([(k, " ".join(t)) for k, t in docs], "doc_id long, text string").repartition(3)
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in dc.find_copies(spark, d, b).collect()} == want
    assert len(want) > 40
