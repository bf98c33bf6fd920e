import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from streamtab.llm import lm, rnn
from streamtab.llm.common import word_lists, words
from tests.llm.helpers import nothing, odd


def small_model(seed=0):
    rng = np.random.default_rng(seed)
    word = np.log(rng.dirichlet(np.ones(3), 2))
    return rnn.initial(word, np.log(rng.dirichlet(np.ones(4))), seed)


def test_probabilities_add_up():
    model = small_model()
    first = [0, 7, 3]
    logs = [rnn.Pass(model, 0).run([np.array(first + [t], np.int32)])[0] for t in range(8)]
    before = rnn.Pass(model, 0).run([np.array(first, np.int32)])[0]
    assert abs(sum(math.exp(x - before) for x in logs) - 1) < 1e-4


def test_state_is_carried_and_lanes_do_not_matter():
    model = small_model(2)
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 8, n).astype(np.int32) for n in (1, 5, 16, 17, 60, 33, 2, 40)]
    together = rnn.Pass(model, 0).run(docs)
    alone = [rnn.Pass(model, 0).run([d])[0] for d in docs]
    np.testing.assert_allclose(together, alone, rtol=1e-4)


def test_gradients(monkeypatch):
    model = {k: v.astype(np.float64) for k, v in small_model(3).items()}
    docs = [np.array(d, np.int32) for d in ([1, 7, 2, 5], [3, 3, 6], [0])]
    monkeypatch.setattr(rnn, "RATE", 0.0)
    monkeypatch.setattr(rnn, "CLIP", 1e9)
    run = rnn.Pass(model, 0, learn=True)
    run.run(docs)
    for name, eps in (("state", 1e-2), ("class", 1e-2), ("word", 1e-2), ("inputs", 1e-2)):
        squared = run.squares[name] - 1e-7
        at = np.unravel_index(int(squared.argmax()), squared.shape)
        values = []
        for step in (eps, -eps):
            changed = {k: v.copy() for k, v in model.items()}
            changed[name][at] += step
            values.append(-rnn.Pass(changed, 0).run(docs).sum() / run.share)
        slope = (values[0] - values[1]) / (2 * eps)
        assert abs(abs(slope) - math.sqrt(squared[at])) < 0.05 * abs(slope) + 1e-5


def test_learning_finds_a_pattern():
    model = rnn.initial(np.log(np.full((2, 3), 1 / 3)), np.log(np.full(4, 0.25)))
    docs = [np.array([0, 4, 2, 7] * 10, np.int32) for _ in range(200)]
    before = rnn.Pass(model, 0).run(docs[:1])[0]
    run = rnn.Pass(model, 0, learn=True)
    for _ in range(6):
        run.run(docs)
    assert rnn.Pass(model, 0).run(docs[:1])[0] > 0.5 * before


def test_every_window_is_learnt_from():
    docs = [np.repeat(np.arange(5), rnn.WINDOW)[:n].astype(np.int32) for n in (5 * rnn.WINDOW, 5 * rnn.WINDOW, 3 * rnn.WINDOW)]
    model = small_model(4)
    start = model["inputs"].copy()
    rnn.Pass(model, 7, learn=True).run(docs)
    moved = np.abs(model["inputs"] - start).max(axis=1) > 0
    assert moved[[0, 1, 2, 3, 4, 7]].all() and not moved[[5, 6]].any()


def base(docs):
    counts = Counter()
    for key, text in docs:
        if zlib.crc32(("" if key is None else str(key)).encode()) % 7 != 2:
            counts.update(words(text) + [b""])
    total, types = sum(counts.values()), len(counts)
    out = []
    for key, text in docs:
        found = words(text) + [b""]
        score = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in found)
        out.append((key, zlib.crc32(("" if key is None else str(key)).encode()) % 7 == 2, len(found), sum(counts[w] > 0 for w in found), total, round(score, 6)))
    return sorted(out, key=repr)


def picked(df):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in df.collect()), key=repr)


def test_base_scores_with_words_outside_the_table(spark, monkeypatch):
    monkeypatch.setattr(lm, "TABLE_WORDS", 40)
    docs = [(i, " ".join(f"w{(i * j) % (5 + j)}" for j in range(1, 60))) for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert picked(lm.score_documents(spark, df)) == base(docs)


def test_odd_rows(spark):
    df = odd(spark, "score", "row", "ids")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert picked(lm.score_documents(spark, df)) == base(docs)
    assert all(r["score"] < 0 for r in lm.score_documents(spark, df).collect())
    assert lm.score_documents(spark, nothing(spark)).count() == 0
    only_held = spark.createDataFrame([(k, "a b") for k in range(40) if zlib.crc32(str(k).encode()) % 7 == 2], "doc_id long, text string")
    rows = lm.score_documents(spark, only_held).collect()
    assert rows and all((r["train_tokens"], r["n_known"], r["base_score"]) == (0, 0, 0.0) for r in rows)


def test_better_than_the_base_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [r for r in lm.score_documents(spark, docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > 0.985 * sum(r["base_score"] for r in rows)


def test_large_logits_stay_log_probabilities():
    x = np.array([[100.0, 0.0], [-200.0, -300.0], [0.0, 0.0]], np.float32)
    picked, grown, total = rnn._softmax(x, np.array([0, 1, 0]))
    assert np.allclose(picked, [0, -100, np.log(0.5)], atol=1e-5) and np.isfinite(grown).all() and (picked <= 0).all()


def test_a_window_takes_two_softmaxes_and_lanes_leave_scores_alone(monkeypatch):
    """One over all words' classes together, where there was one a class."""
    rng, calls, real = np.random.default_rng(5), [], rnn._softmax
    docs = [rng.integers(0, 6 * rnn.CLASS_SIZE + 4, n).astype(np.int32) for n in rng.integers(1, 60, 40)]
    log_word = np.log(rng.dirichlet(np.ones(rnn.CLASS_SIZE), 6))
    model = rnn.initial(log_word, np.log(rng.dirichlet(np.ones(10))))
    monkeypatch.setattr(rnn, "_softmax", lambda *a: calls.append(1) or real(*a))
    steps = len(rnn.lanes(docs, rnn.LANES)[0])
    apart = rnn.Pass(model, 0).run(docs)
    assert len(calls) <= 2 * -(-steps // rnn.WINDOW)
    assert np.allclose(apart, [rnn.Pass(model, 0).run([d])[0] for d in docs], rtol=1e-6)
    # Against the probabilities written out: class, then word within it.
    state = np.zeros((1, rnn.UNITS), np.float32)
    want, before = 0.0, 0
    for y in docs[0]:
        state = rnn.Pass(model, 0)._states(np.array([[before]]), np.zeros((1, 1), bool), state)[4][0]
        logits = state[0] @ model["class"] + model["class_bias"]
        group = y // rnn.CLASS_SIZE if y < 6 * rnn.CLASS_SIZE else y - 6 * rnn.CLASS_SIZE + 6
        want += logits[group] - np.log(np.exp(logits).sum())
        if y < 6 * rnn.CLASS_SIZE:
            logits = state[0] @ model["word"][group] + model["word_bias"][group]
            want += logits[y % rnn.CLASS_SIZE] - np.log(np.exp(logits).sum())
        before = y
    assert np.isclose(apart[0], want, rtol=1e-4)


def test_word_lists_are_the_words():
    texts = [None, "", " ", "a", " a\tB\n", "\x0b\x0cx\r\n\r\ny z", "\u00c4 \u00a0 \u0085q\x1c", "  \u2003"]
    found, cuts = word_lists(pa.array(texts, pa.string()))
    listed = [w.encode() for w in found.to_pylist()]
    assert [listed[x:y] for x, y in zip(cuts[:-1], cuts[1:])] == [words(t) for t in texts]


def test_run_sums_are_those_of_reduceat():
    rng = np.random.default_rng(6)
    for most in (1, 4, 9, 300):
        sizes = rng.integers(1, most + 1, 60)
        first, rows = np.cumsum(sizes) - sizes, rng.standard_normal((int(sizes.sum()), 5)).astype(np.float32)
        assert (rnn._run_sums(rows, first) == np.add.reduceat(rows, first, axis=0)).all()


def test_rows_of_a_table_do_not_lie_a_power_of_two_apart():
    """There a copy by columns takes several times as long, and a full window has 4,096 rows."""
    for count in (0, 1, 16, 100, rnn.WINDOW * rnn.LANES, rnn.WINDOW * rnn.SCORE_LANES):
        table = rnn._table(80, count)
        apart = table.strides[0] // table.itemsize
        assert table.shape == (80, count) and count <= apart < count + 48 and apart % 32 == 16


def test_learning_is_that_of_the_steps_written_out():
    """One window of one lane: gates, candidate and the gradient of the state's weights, step by step."""
    model = small_model(5)
    doc, was = np.array([1, 7, 2, 5, 3], np.int32), {k: v.copy() for k, v in model.items()}
    before, starts = np.array([[0], [1], [7], [2], [5]]), np.array([[True], [False], [False], [True], [False]])
    kept, gates, news, inner, states = rnn.Pass(model, 0)._states(before, starts, np.ones((1, rnn.UNITS), np.float32))
    state, u = np.ones(rnn.UNITS, np.float32), rnn.UNITS
    for t in range(5):
        state = np.zeros_like(state) if starts[t, 0] else state
        x, g = was["inputs"][before[t, 0]], state @ was["state"]
        z, r = 1 / (1 + np.exp(-x[:u] - g[:u])), 1 / (1 + np.exp(-x[u : 2 * u] - g[u : 2 * u]))
        new = np.tanh(x[2 * u :] + r * g[2 * u :])
        for found, want in ((kept[t, 0], state), (gates[t, 0, 0], z), (gates[t, 1, 0], r), (news[t, 0], new), (inner[t, 0], g[2 * u :])):
            np.testing.assert_allclose(found, want, rtol=1e-4, atol=1e-6)
        state = new + z * (state - new)
        np.testing.assert_allclose(states[t, 0], state, rtol=1e-4, atol=1e-6)
    assert np.isfinite(rnn.Pass(model, 0, learn=True).run([doc])).all()


def test_counts_are_those_of_the_words_however_often_they_are_handed_on(spark, monkeypatch):
    texts = [None, "", " ", "a B\tb", "Ä   a", "x " * 50, "b\x0bB\x1c b"]
    want = Counter(w for t in texts for w in words(t))
    want[b""] = len(texts)
    for most in (0, 1 << 26):
        monkeypatch.setattr(lm, "COUNTED_BYTES", most)
        df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
        assert {bytes(r["word"]): r["n"] for r in lm.count_words(spark, df).collect()} == want
    assert lm.count_words(spark, spark.createDataFrame([], "text string")).count() == 0
