import random
import re

import pytest

from streamtab.llm import lines
from tests.llm.helpers import nothing, odd


def words(line):
    return len(re.findall(r"[^\x20\x09-\x0D]+", line))


def brute(docs, least):
    """Every stretch of lines of at least so many words; all lines of one that started earlier go."""
    order = sorted({d for d in docs if d[1] is not None}, key=lambda d: (d[0] is not None, d[0] or 0, lines_key(d)))
    seen, gone = set(), {d: set() for d in order}
    for d in order:
        body = d[1].split("\n")
        for i in range(len(body)):
            stretches = [tuple(body[i:j]) for j in range(i + 1, len(body) + 1) if sum(map(words, body[i:j])) >= least]
            for stretch in stretches:
                if stretch in seen:
                    gone[d] |= set(range(i, i + len(stretch)))
            seen |= set(stretches)
    return {d: "\n".join(x for i, x in enumerate(d[1].split("\n")) if i not in gone[d]) for d in order}


def lines_key(d):
    import hashlib

    md5 = hashlib.md5(d[1].encode()).hexdigest()
    return hashlib.md5(f"{'' if d[0] is None else d[0]}\n{md5}".encode()).digest()


@pytest.mark.parametrize("seed,least", [(1, 4), (2, 9), (3, 1)])
def test_against_brute_force(spark, seed, least):
    rng = random.Random(seed)
    pool = ["a b", "c d\te", "", "f", "g h  i j", " ", "m", "n o p "]
    docs = [(i, "\n".join(rng.choice(pool[: 2 + i % 7]) for _ in range(rng.randrange(1, 14)))) for i in range(40)]
    docs += [(100, docs[3][1]), (101, docs[3][1] + "\nq"), (7, docs[7][1]), (None, docs[5][1]), (8, docs[9][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = brute(docs, least)
    got = lines.dedup_lines(spark, df, min_words=least).collect()
    originals = {}
    for d in docs:
        originals.setdefault((d[0], d[1].count("\n") + 1), []).append(want[d])
    assert len(got) == len(docs)
    for row in got:
        assert row["text"] in originals[(row["doc_id"], row["n_lines"])]
    assert sorted(r["text"] for r in got) == sorted(want[d] for d in docs)


def test_odd_rows(spark):
    df = odd(spark, "n_lines", "doc", "cuts", "c", "start")
    got = lines.dedup_lines(spark, df)
    assert set(got.columns) == {*df.columns, "n_deleted"}
    rows = {(r["doc_id"], r["text"]): r for r in got.collect()}
    assert rows[(1, None)]["n_lines"] == 0 and rows[(2, "")]["n_lines"] == 1 and rows[(3, " \t\n")]["n_lines"] == 2
    assert got.count() == df.count() and all(r["doc"] == "kept" for r in got.collect())
    assert lines.dedup_lines(spark, nothing(spark)).count() == 0


def test_only_expressions_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b\nc"), (2, "a b\nc")], "doc_id long, text string")
    plan = lines.dedup_lines(spark, df, min_words=2)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_whole_runs_go_and_words_are_words(spark):
    forty, other, eight = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("a", 40), ("b", 40), ("c", 8)))
    run = f"{forty}\n{other}\n{eight}\n"
    padded, tabbed = "word" + " " * 60, "\t".join(f"t{i}" for i in range(60))
    docs = [(1, f"one\n{run}\ntwo"), (2, f"three\n{run}\nfour"), (3, padded), (4, padded), (5, tabbed), (6, f"{tabbed}\nsix"), (7, f"{other}\n{eight}\nseven")]
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    # 40 + 8 words are no run of 50.
    assert got == {1: docs[0][1], 2: "three\nfour", 3: padded, 4: padded, 5: tabbed, 6: "six", 7: docs[6][1]}


def test_a_hot_class_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lines, "HOT_SHARE", 3)
    docs = [(i, f"own {i}\na b c d\ne f\ng") for i in range(30)] + [(30 + i, f"x y {i % 3}\nz\nq {i}") for i in range(9)]
    want = brute(docs, 4)
    got = lines.dedup_lines(spark, spark.createDataFrame(docs, "doc_id long, text string"), min_words=4).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {d[0]: t for d, t in want.items()}
