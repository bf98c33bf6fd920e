"""Spelling variants by a trie over letter-group counts.

A word's frequency vector counts its letters in 21 groups. One inserted letter raises one count by one, a deleted one lowers one, a
replaced one does both, or neither within a group. So all near words of a word lie on paths of the trie of vectors that leave
its own path by at most one surplus and one deficit. A depth-first search spends that budget, and the words of the leaves it
reaches are verified letter by letter. Of two near words that with the smaller vector asks, of one vector the smaller word: the
deficit is only spent below the surplus, and every pair is met once.

The top levels of the trie are the partitioning: a word is stored under its first counts and asks under every first counts that
its budget reaches, so a task holds one subtree at a time. A subtree with many words is dealt into pieces of bounded size, and the
words that ask are sent to each piece.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtab.llm.common import batches, saved

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
EDIT_EVERY = 199
LETTERS = 6
OCCURRENCES = 5
RATIO = 5
# Levels of the trie from the top: letters whose counts tell most words apart first. What is in no group is in the last one.
GROUPS = (*"eatsonirlhudcm", "gp", "bf", "vw", "ky", "jx", "qz", "áéíóú")
LEVELS = len(GROUPS) + 1
# Levels by which words are dealt to tasks.
TOP = 6
# Words of one subtree that a task holds at a time.
PIECE = 1 << 13
# What of the budget is spent: nothing, the surplus, both.
FRESH, SURPLUS, BOTH = 0, 1, 2
# Distinct words of which a task counts occurrences before it hands them on.
HELD = 1 << 17
_GROUP = {letter: i for i, letters in enumerate(GROUPS) for letter in letters}


def runs(doc_id: object, text: str | None, every: int = EDIT_EVERY) -> Counter:
    """Lower-cased letter runs of a text and how often each occurs, the planted misspellings made: of a run whose checksum with
    the document's id `every` divides, one letter goes."""
    start, out = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), Counter()
    for run, n in Counter(RUN.findall(text.translate(_LOWER)) if text else ()).items():
        check = zlib.crc32(run.encode(), start)
        if check % every == 0:
            place = check % len(run)
            run = run[:place] + run[place + 1 :]
        out[run] += n
    return out


def vector(word: str) -> bytes:
    """Counts of the letter groups, each 255 at most: counts beyond are told apart by the letters only."""
    counts = [0] * LEVELS
    for letter in word:
        counts[_GROUP.get(letter, LEVELS - 1)] += 1
    return bytes(min(c, 255) for c in counts)


def reachable(top: bytes) -> Iterator[tuple[bytes, int]]:
    """(first counts, budget spent) of every subtree that a word with these first counts has to ask, each once."""
    yield top, FRESH
    for i, count in enumerate(top):
        if count < 255:
            up = top[:i] + bytes([count + 1]) + top[i + 1 :]
            yield up, SURPLUS
            for j in range(i + 1, len(top)):
                if top[j]:
                    yield up[:j] + bytes([top[j] - 1]) + up[j + 1 :], BOTH


def near(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point makes one of the other."""
    if len(a) > len(b):
        a, b = b, a
    i, n = 0, len(a)
    while i < n and a[i] == b[i]:
        i += 1
    if n == len(b):
        return i < n and a[i + 1 :] == b[i + 1 :]
    return n + 1 == len(b) and a[i:] == b[i + 1 :]


class Trie:
    """Words under their counts from level `depth` on: dicts by count, a list of (word, n) below the last."""

    def __init__(self, depth: int = 0):
        self.depth, self.root = depth, {}

    def add(self, counts: bytes, word: str, n: int) -> None:
        node = self.root
        for count in counts[self.depth : -1]:
            node = node.setdefault(count, {})
        node.setdefault(counts[-1], []).append((word, n))

    def search(self, counts: bytes, spent: int) -> list[tuple[str, int]]:
        """Words of the leaves on paths that leave `counts` by one letter more at most, and below that by one fewer at most."""
        found, stack = [], [(self.root, self.depth, spent)]
        while stack:
            node, level, spent = stack.pop()
            while node is not None and level < LEVELS:
                count = counts[level]
                level += 1
                if spent == FRESH:
                    child = node.get(count + 1)
                    if child is not None:
                        stack.append((child, level, SURPLUS))
                elif spent == SURPLUS:
                    child = node.get(count - 1)
                    if child is not None:
                        stack.append((child, level, BOTH))
                node = node.get(count)
            if node is not None:
                found += node
        return found

    def near(self, counts: bytes, spent: int, word: str) -> Iterator[tuple[str, int]]:
        """The near words that `word` asks for: all it reaches that come after it by vector and letters."""
        half = len(word) // 2
        start, end = word[:half], word[half:]
        for other, n in self.search(counts, spent):
            # One edit leaves the first or the second half as it is.
            if (other.startswith(start) or other.endswith(end)) and near(word, other) and (word < other or vector(other) != counts):
                yield other, n


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = EDIT_EVERY) -> DataFrame:
    """(word, n) of every letter run of whole texts with its misspellings; counts are added up in the tasks first."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})
            held.clear()
            return made

        for batch in batches(parts, rows=1000, chars=1 << 22):
            for doc_id, body in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
                for run, n in runs(doc_id, body, every).items():
                    held[run] += n
                if len(held) > HELD:
                    yield out()
        yield out()

    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(read, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _placed(words: DataFrame) -> DataFrame:
    """(cell, word, n, counts): every word with its vector, under the subtree it is in."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts, rows=10_000):
            counts = [vector(w) for w in batch["word"].to_pylist()]
            cells = [c[:TOP] for c in counts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells, pa.binary()), batch["word"], batch["n"], pa.array(counts, pa.binary())], ["cell", "word", "n", "counts"]
            )

    return words.mapInArrow(read, "cell binary, word string, n long, counts binary")


def _asking(placed: DataFrame) -> DataFrame:
    """(cell, word, n, counts, spent) of the subtrees a word asks."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts, rows=2000):
            cells, spent, rows = [], [], []
            for i, top in enumerate(batch["cell"].to_pylist()):
                for cell, state in reachable(top):
                    cells.append(cell)
                    spent.append(state)
                    rows.append(i)
            rows = pa.array(rows, pa.int64())
            own = [batch[c].take(rows) for c in ("word", "n", "counts")]
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.binary()), *own, pa.array(spent, pa.int8())], ["cell", "word", "n", "counts", "spent"])

    return placed.mapInArrow(read, "cell binary, word string, n long, counts binary, spent byte")


def near_words(spark: SparkSession, words: DataFrame, piece: int = PIECE) -> DataFrame:
    """(word, n_near, best_n, best) of the words of (word, n) that have near ones: how many, and the one of largest n, of equal n the first."""
    placed = saved(spark, _placed(words), "spelling-placed")
    cells = placed.groupBy("cell").agg(F.ceil(F.count("*") / piece).cast("int").alias("pieces"))
    cells = saved(spark, cells, "spelling-cells")
    # Only subtrees that exist are asked, each piece of them. The stored words of a piece, `spent` null, come before those that ask.
    asking = _asking(placed).join(cells, "cell").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    asking = asking.select("cell", "piece", "word", "n", "counts", "spent")
    own = placed.join(cells, "cell").select(
        "cell", F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int").alias("piece"), "word", "n", "counts", F.lit(None).cast("byte").alias("spent")
    )

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, trie = None, Trie(TOP)
        for batch in batches(parts, rows=5000):
            # Word to (near words, -n of the best, best).
            found: dict[str, tuple[int, int, str]] = {}

            def tell(word: str, other: str, n: int, found: dict = found) -> None:
                seen, least, best = found.get(word, (0, 1, ""))
                found[word] = (seen + 1, *min((least, best), (-n, other)))

            for cell, part, word, n, counts, spent in zip(*(batch[c].to_pylist() for c in ("cell", "piece", "word", "n", "counts", "spent"))):
                if (cell, part) != current:
                    current, trie = (cell, part), Trie(TOP)
                if spent is None:
                    trie.add(counts, word, n)
                    continue
                for other, k in trie.near(counts, spent, word):
                    tell(word, other, k)
                    tell(other, word, n)
            columns = zip(*((w, k, -n, best) for w, (k, n, best) in found.items())) if found else ((),) * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["word", "n_near", "best_n", "best"])

    together = own.unionByName(asking).repartition("cell", "piece").sortWithinPartitions("cell", "piece", F.col("spent").asc_nulls_first())
    found = together.mapInArrow(search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("k"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.k")).alias("best_n"), F.col("b.best").alias("best")
    )


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) with a form: every word takes the form of its form until none has another. Counts rise along a chain
    by the ratio at least, so chains are short."""
    links = saved(spark, forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        beyond = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        after = saved(spark, links.join(beyond, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), "beyond"), "spelling-roots")
        links = after.select("word", "root")
        if after.where("beyond IS NOT NULL").isEmpty():
            return links


def group_spellings(
    spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = LETTERS, occurrences: int = OCCURRENCES,
    ratio: int = RATIO, every: int = EDIT_EVERY, piece: int = PIECE,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the words with enough letters and occurrences.

    `form` is the near word of largest n (of equal n the first in code-point order) if that is `ratio` times the word's at least, else null;
    `root` the end of the chain of forms. Null and empty texts have no words, a null id is an empty one, repeated rows count each.
    No words: no rows.
    """
    counted = word_counts(docs, key, text, every).where((F.length("word") >= letters) & (F.col("n") >= occurrences))
    words = saved(spark, counted, "spelling-words")
    out = words.join(near_words(spark, words, piece), "word", "left")
    well = F.col("best_n") >= ratio * F.col("n")
    out = out.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(well, F.col("best")).alias("form"),
                     F.when(well, F.col("best_n")).alias("form_n"))
    out = saved(spark, out, "spelling-forms")
    roots = _roots(spark, out.where("form IS NOT NULL"))
    return out.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
