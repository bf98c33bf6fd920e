import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from streamtab.llm import decontam, mix, quality
from tests.llm.helpers import listed
from tests.llm.test_partenum import brute as components

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(stage(spark, out[-1], FOLDER).cache())
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_quality(spark, steps):
    forest = quality.fit(steps[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    want = set()
    for r in steps[0].collect():
        counts, rates = quality.measure([r["text"]])
        words, repeated = len((r["text"] or "").encode().split()), counts[0][4]
        if words >= 10 and 100 * repeated <= 20 * words and forest.scores(rates)[0] <= forest.threshold:
            want.add(r["doc_id"])
    assert ids(steps[1]) == want and steps[1].columns == steps[0].columns


def test_one_of_each_group_stays(steps):
    docs = [(r["doc_id"], r["text"]) for r in steps[1].collect()]
    assert ids(steps[2]) == {c for _, _, c in components(docs)}
    assert steps[2].count() == len(ids(steps[2])) and steps[2].columns == steps[0].columns


def test_copies_of_benchmark_items_go(spark, steps):
    items = [b" ".join(decontam.normal_words(r["text"])) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    holds = lambda text: any(i in b" ".join(decontam.normal_words(text)) for i in items)
    kept = ids(steps[3])
    assert kept == {r["doc_id"] for r in steps[2].collect() if not holds(r["text"])}


def test_mix(spark, steps):
    times = Counter(r["doc_id"] for r in steps[4].collect())
    assert steps[4].columns == steps[0].columns
    want = {r["doc_id"]: r["times"] for r in mix.mix(spark, steps[3]).collect() if r["times"]}
    assert times == want


def test_tokens(steps):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, want = 0, []
    for r in sorted(steps[4].collect(), key=lambda r: (r["doc_id"], r["text"])):
        coded = plain.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        want.append((r["doc_id"], start, len(coded), zlib.crc32(np.array(coded, "<u4").tobytes())))
        start += len(coded)
    assert listed(steps[5]) == sorted(want, key=repr)


def test_run_is_the_stages_in_a_row(spark, steps):
    assert listed(cp.run(spark, FOLDER)) == listed(steps[5])


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_near_copies_between_80_and_85_percent_go(spark):
    text = [f"w{i}" for i in range(104)]
    own = " ".join(text)
    near, far = (" ".join(text + [f"x{i}" for i in range(n)]) for n in (22, 27))
    docs = spark.createDataFrame([(1, own), (2, near), (3, "other " + far.replace("w", "v")), (4, far.replace("w", "u")), (5, own.replace("w", "u"))], "doc_id long, text string")
    docs = docs.selectExpr("*", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    # 100 shingles of five words in 122 are common to 1 and 2; 100 in 127 to 4 and 5.
    assert ids(cp.near_duplicates(spark, docs, FOLDER)) == {1, 3, 4, 5}
