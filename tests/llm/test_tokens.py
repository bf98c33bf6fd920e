import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from streamtab.llm import tokens
from tests.llm.helpers import listed, nothing, odd

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
ENCODER = tokens.WordEncoder(PATH, limit=60)
TEXT = st.lists(st.one_of(st.text(max_size=12), st.sampled_from(["don't", "<|endoftext|>", "It's", "naïve,", "ÉTÉ!", "(x)", "12ab", "á", "\x1c", "İs", " ", "\n"])), max_size=8).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=3))
def test_word_by_word_is_the_tokenizer(texts):
    got = ENCODER.encode(texts, b"")
    assert [np.frombuffer(g, "<i4").tolist() for g in got] == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_tokenizers_encode_whole_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    texts = ["a b  c", " lead", "", "naïve\n\n😀 x", "<|endoftext|>"]
    got = tokens.WordEncoder(path).encode(texts, b"")
    assert [np.frombuffer(g, "<i4").tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    df = spark.createDataFrame([*enumerate(texts), (5, None)], "doc_id long, text string")
    read = tokens.read_metadata(spark, tokens.write_tokens(spark, df, tokenizer=path, end_id=50256), ids=True).orderBy("doc_id").collect()
    assert [r["ids"] for r in read] == [plain.encode(t, add_special_tokens=False).ids + [50256] for t in [*texts, ""]]


def test_words_are_forgotten_by_bytes():
    encoder = tokens.WordEncoder(PATH, limit_bytes=400)
    for i in range(30):
        ids, sizes = encoder.ids_of([f"word{i} {'x' * i}".encode(), None], 1)
        assert ids.tolist() == PLAIN.encode(f"word{i} {'x' * i}", add_special_tokens=False).ids + [1, 1] and sizes.sum() == len(ids)
        assert encoder.held <= 400


def brute(docs):
    start, out = 0, []
    for key, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, (d[1] or "").encode())):
        ids = PLAIN.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_files_read_back(spark):
    docs = [(i * 7 % 101, f"Word {i}, naïve {'again ' * (i % 5)}") for i in range(101)] + [(5, None), (None, "x y"), (None, None), (9, ""), (9, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    path = tokens.write_tokens(spark, df)
    assert listed(tokens.checksums(tokens.read_metadata(spark, path, ids=True))) == brute(docs)
    assert listed(tokens.read_metadata(spark, path)) == sorted([r[:3] for r in brute(docs)], key=repr)


def test_metadata_reads_leave_the_ids_alone(spark):
    path = tokens.write_tokens(spark, spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string"))
    plan = tokens.read_metadata(spark, path).where("doc_id = 2")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan and "EqualTo(doc_id,2)" in plan


def test_layout(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.createDataFrame([(i, f"some words {i} " * 40) for i in range(3000)], "doc_id long, text string").coalesce(1)
    path = tokens.write_tokens(spark, df, path=str(tmp_path / "t"))
    file = next((tmp_path / "t").glob("part-*.parquet"))
    columns = {c.path_in_schema: c for c in (pq.ParquetFile(file).metadata.row_group(0).column(i) for i in range(5))}
    ids = next(c for n, c in columns.items() if n.startswith("ids"))
    assert any("DICTIONARY" in e for e in ids.encodings)
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and columns["doc_id"].has_column_index
    assert path.endswith("t")


def test_odd_rows(spark):
    df = odd(spark, "part", "ids", "start")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = tokens.checksums(tokens.read_metadata(spark, tokens.write_tokens(spark, df), ids=True))
    assert listed(got) == brute(rows)
    empty = tokens.write_tokens(spark, nothing(spark))
    assert tokens.checksums(tokens.read_metadata(spark, empty, ids=True)).count() == 0


def test_words_met_again_stay_known_between_tasks(monkeypatch):
    """A task does not learn again what the one before it met more than once; the rest is forgotten, and so is all beyond the bounds."""
    encoder, asked = tokens.WordEncoder(PATH, limit=8), []
    first = encoder.ids_of([b"often rare often", b"often again again"], 1)
    encoder.trim()
    assert set(encoder.index) == {b"often", b"again"} or set(encoder.index) == {b"often", b" "}
    real = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda fresh: asked.extend(fresh) or real(fresh))
    assert all(np.array_equal(x, y) for x, y in zip(first, encoder.ids_of([b"often rare often", b"often again again"], 1)))
    assert b"often" not in asked and b"rare" in asked
    small = tokens.WordEncoder(PATH, limit_bytes=10)
    small.ids_of([b"longish longish words words"], 1)
    small.trim()
    assert not small.index and small.held == 0
