"""Token-ID files: Parquet with a list of ids per document, in key order, made for reading a few columns or a few documents.

Ids are dictionary-encoded (a row group has at most the vocabulary), keys and counts delta-encoded, row groups and pages are small
and carry page indexes, so a reader of metadata skips the ids and a reader of some keys skips the other pages.
"""

from __future__ import annotations

import json
import re
import string
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from streamtab.llm.common import batches
from streamtab.session import scratch_path

END_ID = 1
CACHE_WORDS = 400_000
CACHE_BYTES = 32 << 20
# Stands after the words of a text; no word holds a space.
_END = b" "
LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(2 << 20),
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#local_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "compression": "zstd",
}
SCHEMA = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"


# Words of Latin letters below U+0180 with ASCII marks around them, but no apostrophe: composed already, cut at the marks by the
# tokenizer, and lower-cased letter by letter.
_MARKS = "".join(c for c in string.punctuation if c != "'")
_PLAIN = re.compile(f"([{re.escape(_MARKS)}]*)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*)([{re.escape(_MARKS)}]*)")


def byte_characters() -> dict[int, str]:
    """The character that byte-level BPE writes for each byte: itself where it shows, else the next one from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def cuts_at_spaces(tokenizer: Tokenizer) -> bool:
    """Whether a tokenizer drops white space before it merges letters, so that words can be encoded apart as `WordEncoder` does."""
    parts = json.loads(tokenizer.to_str())
    steps = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
    normal = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
    if [s["type"] for s in steps] != ["Split", "ByteLevel"] or normal != ["NFC", "Replace", "Lowercase"]:
        return False
    split, level = steps
    dropped = split["behavior"] == "Removed" and split["invert"] and "[^\\s" in split["pattern"].get("Regex", "")
    return dropped and not level["add_prefix_space"] and not level["use_regex"] and parts["model"]["type"] == "BPE"


class WordEncoder:
    """Ids of texts, each distinct word put through the tokenizer once while it stays in a bounded cache.

    The tokenizer never joins characters across ASCII white space (it drops it before merging, and its normalisers look at
    single characters and combining sequences), so a text's ids are its words' ids in a row. Of a new word in Latin letters, letters and
    marks go to the tokenizer's merging model directly. All other new words of a batch are encoded in one call, divided by a special
    token; words that hold `<|` are encoded alone.
    """

    def __init__(self, path: str, divider: str = "<|startoftext|>", limit: int = CACHE_WORDS, limit_bytes: int = CACHE_BYTES):
        self.tokenizer = Tokenizer.from_file(path)
        self.divider, self.mark = divider, self.tokenizer.token_to_id(divider)
        self.by_word = cuts_at_spaces(self.tokenizer) and self.mark is not None
        self.limit, self.limit_bytes = limit, limit_bytes
        self.table = str.maketrans({chr(b): c for b, c in byte_characters().items()})
        self.forget()

    def forget(self) -> None:
        """Empty the caches: `index` numbers words as they are met, and word i has the ids `flat[begin[i] : begin[i] + size[i]]`."""
        self.index: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.flat, self.begin, self.size = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
        # How often each word was met since the last trim.
        self.met = np.empty(0, np.int64)
        self.pieces: dict[str, bytes] = {}
        self.held = 0

    def trim(self) -> None:
        """Keep the words that were met again, at most a quarter of the limit: those come next, most others were met once and never will be."""
        kept = np.flatnonzero(self.met > 1)
        if len(kept) > self.limit // 4:
            kept = np.sort(kept[np.argsort(-self.met[kept], kind="stable")[: self.limit // 4]])
        listed = list(self.index)
        words = [listed[i] for i in kept.tolist()]
        begin, size = self.begin[kept], self.size[kept]
        held = sum(map(len, words)) + 4 * int(size.sum())
        flat = self.flat[np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)]
        self.forget()
        if held <= self.limit_bytes // 2:
            self.index = defaultdict(count(len(words)).__next__, zip(words, range(len(words))))
            self.flat, self.begin, self.size, self.held = flat, np.cumsum(size) - size, size, held
            self.met = np.zeros(len(words), np.int64)

    def _alone(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<i4").tobytes()

    def _piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.table)
        found = self.pieces[piece] = array("i", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()
        return found

    def _learn(self, fresh: list[bytes]) -> dict[bytes, bytes]:
        others, known, pieces, match = [], {}, self.pieces, _PLAIN.fullmatch
        for word in fresh:
            if b"<|" in word:
                known[word] = self._alone(word)
                continue
            found = match(word.decode("utf-8", "replace"))
            if found is None:
                others.append(word)
                continue
            before, letters, after = found.groups()
            letters = letters.lower()
            ids = (pieces.get(letters) or self._piece(letters)) if letters else b""
            if before:
                ids = (pieces.get(before) or self._piece(before)) + ids
            known[word] = ids + (pieces.get(after) or self._piece(after)) if after else ids
        for start in range(0, len(others), 5000):
            some = others[start : start + 5000]
            text = self.divider.join(w.decode("utf-8", "replace") for w in some)
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<i4")
            cuts = np.flatnonzero(ids == self.mark)
            data, begin = ids.tobytes(), np.concatenate([[0], cuts + 1]) * 4
            stop = np.append(cuts, len(ids)) * 4
            known.update((w, data[a:b]) for w, a, b in zip(some, begin.tolist(), stop.tolist()))
        return known

    def _whole(self, texts: list[bytes | None], end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        coded = self.tokenizer.encode_batch([(t or b"").decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        found = [e.ids if end_id is None else [*e.ids, end_id] for e in coded]
        return np.fromiter(chain.from_iterable(found), np.int32), np.fromiter(map(len, found), np.int64, len(found))

    def ids_of(self, texts: list[bytes | None], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all UTF-8 `texts` in a row, `end_id` after each, and how many each text has.

        Words become numbers in one look-up each, new ones take the next number; the rest is done on arrays of numbers. With a
        tokenizer that does not cut at white space, texts are encoded whole.
        """
        if not self.by_word:
            return self._whole(texts, end_id)
        split = [(t or b"").split() for t in texts]
        if end_id is not None:
            for found in split:
                found.append(_END)
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), np.int64, int(lengths.sum()))
        new = len(self.index) - len(self.size)
        if new:
            fresh = list(islice(reversed(self.index), new))[::-1]
            known = self._learn([w for w in fresh if w != _END])
            if end_id is not None:
                known[_END] = np.array([end_id], "<i4").tobytes()
            coded = [known[w] for w in fresh]
            size = np.fromiter(map(len, coded), np.int64, new) // 4
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(coded), "<i4")])
            self.held += sum(map(len, fresh)) + 4 * int(size.sum())
            self.met = np.append(self.met, np.zeros(new, np.int64))
        self.met += np.bincount(at, minlength=len(self.met))
        sizes = self.size[at]
        reach = np.append(0, np.cumsum(sizes))
        ids = self.flat[np.arange(reach[-1]) + np.repeat(self.begin[at] - reach[:-1], sizes)]
        if len(self.index) > self.limit or self.held > self.limit_bytes:
            self.trim()
        return ids, np.diff(reach[np.append(0, np.cumsum(lengths))])

    def encode(self, texts: list[str | None], end: bytes) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers, `end` appended."""
        ids, sizes = self.ids_of([None if t is None else t.encode("utf-8", "surrogatepass") for t in texts])
        return [part.astype("<i4").tobytes() + end for part in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []


@lru_cache(maxsize=1)
def _encoder(path: str, end_id: int) -> WordEncoder:
    """One encoder a worker process, for one end id; `trim` frees most of its words when a task ends."""
    return WordEncoder(path)


def write_tokens(
    spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, key: str = "doc_id", text: str = "text", end_id: int = END_ID, path: str | None = None
) -> str:
    """Write the ids of all `docs` in ascending key order (null keys first, ties by text) and return the folder.

    One range shuffle of the texts puts neighbouring keys into one file; each task then encodes and counts as it writes. A null or
    empty text is the end id alone. Repeated rows stay repeated. Files are named in order, and `part` holds that order.
    """
    file = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, start, encoder = TaskContext.get().partitionId(), 0, _encoder(file, end_id)
        for batch in batches(parts, rows=2000, chars=1 << 22):
            ids, sizes = encoder.ids_of(batch["text"].cast(pa.binary()).to_pylist(), end_id)
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "part": pa.array(np.full(len(sizes), part, np.int32)), "local_start": pa.array(start + ends - sizes),
                 "n_tokens": pa.array(sizes), "ids": pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids))})
            start += int(sizes.sum())
        # The worker process goes on to other tasks, maybe of other stages: only common words stay.
        encoder.trim()

    path = path or scratch_path(spark, "tokens")
    rows.mapInArrow(encode, SCHEMA).write.options(**LAYOUT).parquet(path)
    return path


def read_metadata(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens[, ids]) of every document in the files, `start` counted over all files.

    The files' totals come from the count column alone; there is one row per file, which is what is broadcast.
    """
    files = spark.read.schema(SCHEMA).parquet(path)
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    out = files.join(F.broadcast(sizes), "part").withColumn("start", F.col("offset") + F.col("local_start"))
    return out.select("doc_id", "start", "n_tokens", *(["ids"] if ids else []))


def checksums(documents: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of documents read with their ids; n_tokens is counted from the ids."""

    def check(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            lists = batch["ids"]
            cuts, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<i4", copy=False)
            sums = [zlib.crc32(values[a:b].data) for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "start": batch["start"], "n_tokens": pa.array(np.diff(cuts).astype(np.int64)),
                 "ids_crc32": pa.array(sums, pa.int64())})

    return documents.mapInArrow(check, "doc_id long, start long, n_tokens long, ids_crc32 long")
