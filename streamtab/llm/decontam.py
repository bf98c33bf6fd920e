"""Benchmark decontamination: rare words of test items seed alignments, and Smith-Waterman scores say which passages are copies.

A copy may keep no two words of its item side by side (a word put in after each), so seeds are single words, in a number that no copy
can do without. The words of test items, not of documents, are what is looked up: documents are streamed past a block of items twice,
once to count how many documents hold each word of an item and once to align.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtab.llm.common import batches, packed, saved

MATCH, MISMATCH, GAP = 2, -1, -1
# Share of an item's best possible score that makes a passage a copy of it.
MIN_SCORE = 0.5
# Words of test items that are broadcast at a time; larger benchmarks take more passes.
BLOCK_WORDS = 1 << 20
# Counts of seeds by stretch and item that are held at a time.
CELLS = 1 << 22
HITS = "item_id long, score double, first_word long, last_word long"

_BREAKS = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def normal_words(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_BREAKS).split() if text else []


class Items:
    """Test items as codes, which are places in the vocabulary of all items, and the items that each seed word points to.

    A passage that scores `least` matches at least that share of its item's words. So of any words of an item that are as many as may
    be missing and `held` more, every copy has `held`; the rarest are taken. `reach` is how many words a copy can be long.
    """

    def __init__(self, rows: list[tuple[int, list[bytes]]], least: float = MIN_SCORE):
        self.places: dict[bytes, int] = {}
        self.rows = [(i, np.array([self.places.setdefault(w, len(self.places)) for w in own], np.int64)) for i, own in rows]
        self.counted = [np.unique(own, return_counts=True) for _, own in self.rows]
        self.needed = [max(1, math.ceil(least * len(own) - 1e-9)) for _, own in self.rows]
        self.held = np.array([(3 * n + 3) // 4 for n in self.needed], np.int64)
        self.reach = [len(own) + int(MATCH * len(own) * (1 - least) / -GAP) for _, own in self.rows]
        self.longest = max(self.reach)
        # How often the item at hand holds each word; the last place is for words in no item.
        self.times = np.zeros(len(self.places) + 1, np.int64)

    def codes(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.places.get, found, repeat(-1)), np.int64, len(found))

    def seed(self, frequency: np.ndarray) -> None:
        """Index the items by their rarest words."""
        pairs = []
        for k, (_, own) in enumerate(self.rows):
            rare = own[np.argsort(frequency[own], kind="stable")[: len(own) - self.needed[k] + int(self.held[k])]]
            pairs.append(np.stack([rare, np.full(len(rare), k)], axis=1))
        word, self.pointed = np.concatenate(pairs).T
        order = np.argsort(word, kind="stable")
        self.pointed = self.pointed[order]
        self.starts = np.searchsorted(word[order], np.arange(len(self.places) + 1))

    def candidates(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, low, high): runs of a document's words with enough seeds of an item, by pairs of neighbouring stretches.

        Stretches have the longest reach, so every copy lies within a pair.
        """
        at = np.flatnonzero(codes >= 0)
        stretch, size, hits = at // self.longest, len(self.places), []
        # Each word counts once in the pair that its stretch begins and once in the pair that it ends.
        keys = np.unique(np.concatenate([stretch, stretch + 1]) * size + np.tile(codes[at], 2))
        pair, words = np.divmod(keys, size)
        pairs = max(1, CELLS // len(self.rows))
        for low in range(0, int(pair[-1]) + 1 if len(pair) else 0, pairs):
            cut = slice(*np.searchsorted(pair, [low, low + pairs]))
            first, sizes = self.starts[words[cut]], self.starts[words[cut] + 1] - self.starts[words[cut]]
            entry = np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)
            cell = np.repeat(pair[cut] - low, sizes) * len(self.rows) + self.pointed[entry]
            most = int(pair[cut][-1]) - low + 1 if cut.stop > cut.start else 0
            counts = np.bincount(cell, minlength=most * len(self.rows)).reshape(-1, len(self.rows))
            hits += [(k, p + low) for p, k in np.argwhere(counts >= self.held).tolist()]
        found: list[tuple[int, int, int]] = []
        for k, p in sorted(hits):
            if found and found[-1][0] == k and found[-1][2] >= (p - 1) * self.longest:
                found[-1] = (k, found[-1][1], (p + 1) * self.longest)
            else:
                found.append((k, max(0, p - 1) * self.longest, (p + 1) * self.longest))
        return found

    def passages(self, k: int, codes: np.ndarray) -> list[tuple[int, int]]:
        """Stretches outside which no run of `reach` words shares enough words with item k, each counted as often as the item has it."""
        reach, (words, counts) = self.reach[k], self.counted[k]
        self.times[words] = counts
        most = self.times[codes]
        self.times[words] = 0
        at = np.flatnonzero(most)
        if len(at) < self.needed[k]:
            return []
        order = at[np.argsort(codes[at], kind="stable")]
        # The occurrence so many back that with it in the run this one is one too many.
        back = np.arange(len(order)) - most[order]
        before = order[np.maximum(back, 0)]
        before = np.where((back >= 0) & (codes[before] == codes[order]), before, -1)
        # It counts in the runs that begin behind that one, and at most `reach` words before it ends.
        opens = np.sort(np.maximum(before + 1, order - reach + 1))
        shared = np.searchsorted(opens, at, "right") - np.arange(len(at))
        begins = at[shared >= self.needed[k]]
        if not len(begins):
            return []
        cuts = np.flatnonzero(np.diff(begins) > reach)
        return [(int(a), int(b) + reach) for a, b in zip(begins[np.r_[0, cuts + 1]], begins[np.r_[cuts, len(begins) - 1]])]


def align(item: np.ndarray, passage: np.ndarray, least: float = 0) -> tuple[int, int, int]:
    """Best local alignment: score, and the first and last word of the passage in it (score 0, or under `least`: no word).

    Row by row; a gap along the row is a running maximum of scores that lose GAP per word.
    """
    if not len(item) or not len(passage):
        return 0, 0, -1

    def best(rows: np.ndarray, across: np.ndarray) -> tuple[int, int]:
        slope = -GAP * np.arange(len(across) + 1)
        above, top, end = np.zeros(len(across) + 1, np.int64), 0, -1
        for word in rows:
            row = np.zeros_like(above)
            row[1:] = np.maximum(above[:-1] + np.where(across == word, MATCH, MISMATCH), above[1:] + GAP)
            row = np.maximum.accumulate(np.maximum(row, 0) + slope) - slope
            at = int(row.argmax())
            if row[at] > top:
                top, end = int(row[at]), at - 1
            above = row
        return top, end

    score, last = best(item, passage)
    if not score or score < least:
        return 0, 0, -1
    _, back = best(item[::-1], passage[last::-1])
    return score, last - back, last


def copies(items: Items, codes: np.ndarray, least: float = MIN_SCORE) -> list[tuple[int, float, int, int]]:
    """(item, score, first, last word) of each item of which the document holds a copy, best passage of each."""
    best: dict[int, tuple[int, float, int, int]] = {}
    for k, start, stop in items.candidates(codes):
        item_id, own = items.rows[k]
        for low, high in items.passages(k, codes[start:stop]):
            low, high = start + low, start + high
            score, first, last = align(own, codes[low:high], least * MATCH * len(own))
            share = score / (MATCH * len(own))
            if score and share >= least and (k not in best or share > best[k][1]):
                best[k] = (item_id, share, low + first, low + last)
    return list(best.values())


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Test items in blocks of about BLOCK_WORDS words; an item is read by the driver, a benchmark never as a whole."""
    rows = benchmark.select(F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    block, size = [], 0
    for row in rows.dropDuplicates().orderBy("item", "text").toLocalIterator():
        found = normal_words(row["text"])
        if found:
            block.append((row["item"], found))
            size += len(found)
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_copies(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", least: float = MIN_SCORE
) -> DataFrame:
    """(key, item_id, score, first_word, last_word) of every document that holds a copy of a test item, one row per pair.

    These are all pairs in which some passage of the document scores at least `least`. `score` is the alignment's share of the item's
    best possible score, over normalised words (lower case, no punctuation); words are counted from 0. Null and empty texts and items hold
    nothing; repeated rows each have their row; a benchmark item may have several texts.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = spark.createDataFrame([], f"id {kind}, {HITS}")
    for block in _blocks(benchmark, item, item_text):
        out = out.unionByName(_find_block(spark, rows, kind, block, least))
    return out.withColumnRenamed("id", key)


def _find_block(spark: SparkSession, rows: DataFrame, kind: str, block: list[tuple[int, list[bytes]]], least: float) -> DataFrame:
    shared = spark.sparkContext.broadcast(block)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(shared.value, least)
        held = np.zeros(len(items.places) + 1, np.int64)
        for batch in batches(parts, chars=1 << 24):
            for value in batch["text"].to_pylist():
                held[np.unique(items.codes(normal_words(value)))] += 1
        at = np.flatnonzero(held[:-1])
        yield pa.RecordBatch.from_pydict({"word": pa.array(at), "docs": pa.array(held[at])})

    frequency = np.zeros(len({w for _, own in block for w in own}), np.int64)
    for row in rows.select("text").mapInArrow(count, "word long, docs long").groupBy("word").agg(F.sum("docs").alias("docs")).collect():
        frequency[row["word"]] = row["docs"]

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Items(shared.value, least)
        mine.seed(frequency)
        for batch in batches(parts, chars=1 << 24):
            found = [(i, *c) for i, value in zip(batch["id"].to_pylist(), batch["text"].to_pylist()) for c in copies(mine, mine.codes(normal_words(value)), least)]
            ids, item, score, first, last = zip(*found) if found else ([],) * 5
            yield pa.RecordBatch.from_pydict(
                {"id": pa.array(ids, batch.schema.field("id").type), "item_id": pa.array(item, pa.int64()), "score": pa.array(score, pa.float64()),
                 "first_word": pa.array(first, pa.int64()), "last_word": pa.array(last, pa.int64())})

    return rows.mapInArrow(search, f"id {kind}, {HITS}")


def without_copies(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", least: float = MIN_SCORE) -> DataFrame:
    """The rows of `docs` that hold no copy of a test item, with all their columns."""
    mark = F.struct(F.col(f"`{key}`").alias("key"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("digest"))
    marked = docs.select(mark.alias("doc"), F.col(f"`{text}`").alias("text"))
    bad = saved(spark, find_copies(spark, marked, benchmark, "doc", "text", least=least).select("doc.key", "doc.digest").distinct(), "decontam-copies")
    d = packed(docs, key=F.col(f"`{key}`"), digest=F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))).alias("d")
    b = bad.alias("b")
    same = F.col("d.key").eqNullSafe(F.col("b.key")) & (F.col("d.digest") == F.col("b.digest"))
    return d.join(b, same, "left_anti").select("row.*")
