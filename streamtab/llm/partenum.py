"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its distinct word shingles. Sets are put into bands of size; within a band the Jaccard threshold bounds how
many elements two linked sets can differ in, so when the domain is split into enough parts, some part differs in one element
at most, and of that part's cells all but one are equal. Each choice of such equal cells is a signature: linked sets share one. Parts that hold next
to nothing would make signatures that a fixed share of all sets has, so there are some parts to spare and such parts count by threes.

Documents with equal sets are one class (its id is a 64-bit digest of the set), and classes are what is joined, so a group of copies
costs what one document costs. Candidates are tested by exact set sizes, and links are only sought between classes that are not yet
in one component, so a large group of near copies is not expanded into its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache, partial, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamtab.llm.common import batches, packed, saved, words
from streamtab.llm.hashing import WordHashes, grams, mixed

SHINGLE = 4
# Linked when 100 * intersection >= PERCENT * union.
PERCENT = 85
CELLS = 3
# Members of a signature group that are compared with each other in one task; larger groups are dealt into parts, each two of which are a group.
GROUP_ROWS = 2048
# Parts of the signatures, shuffled one after the other (a power of two).
TURNS = 4
FILTER_BITS = 24
# Groups from so many members on are compared by arrays; pairs that a task holds to tell each once; elements of sets in a part of a cluster.
WIDE_ROWS = 16
PAIR_ROWS = 1 << 17
PART_ELEMENTS = 1 << 20
# Bits of a signature that are written and shuffled. Sets that share them by chance are candidates like others, which verification drops.
SIGNATURE_MASK = np.uint64((1 << 40) - 1)
# Signatures that are handed on at once (1 MB).
BATCH_SIGNATURES = 1 << 17
_ODD = np.uint64(0x94D049BB133111EB)


def _salt(*numbers: int) -> np.uint64:
    """A constant for some small numbers."""
    total = 0
    for number in numbers:
        total = (total + number + 1) * int(_ODD) & (1 << 64) - 1
    return np.uint64(total)


def shingles(text: str | None, hashes: WordHashes, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; the whole sequence is one when there are fewer words."""
    found = words(text)
    return np.unique(grams(hashes.of(found), min(n, len(found)))) if found else np.empty(0, np.uint64)


def digest(elements: np.ndarray) -> int:
    """64-bit digest of a set, signed as Spark's long."""
    total = mixed(mixed(elements).sum(dtype=np.uint64, keepdims=True) + _salt(len(elements)))
    return int(total.view(np.int64)[0])


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def most_apart(sizes: int, percent: int = PERCENT) -> int:
    """Most elements that two linked sets of `sizes` elements together can have in only one of them."""
    return (100 - percent) * sizes // (100 + percent)


@lru_cache(maxsize=None)
def band(size: int, percent: int = PERCENT) -> tuple[int, int, int]:
    """Number, smallest and greatest size of the band of `size`; bands span the threshold's size ratio twice."""
    number, low = 0, 1
    while True:
        high = max(low, low * 10000 // (percent * percent))
        if size <= high:
            return number, low, high
        number, low = number + 1, high + 1


@lru_cache(maxsize=None)
def schemes(size: int, percent: int = PERCENT) -> tuple[tuple[int, int, int], ...]:
    """(band, elements apart at most, parts to spare) of each band in which a set of this size meets its partners."""
    number, low, high = band(size, percent)
    out = [(number, most_apart(2 * high, percent), low)]
    if 100 * size // percent > high:
        after, low, top = band(high + 1, percent)
        out.append((after, most_apart(2 * top, percent), low))
    # Of the smallest sets that meet others in a band, the parts with one element at most are as many as are to spare, on average.
    return tuple((b, k, _thin_parts(k // 2 + 1, low * percent / 100)) for b, k, low in out if k)


def _thin_parts(parts: int, size: float) -> int:
    """Of so many parts, how many hold at most one element of a set of `size`; two at least."""
    mean = size / parts
    return max(2, int(parts * (1 + mean) * math.exp(-mean)))


def signatures(elements: np.ndarray, percent: int = PERCENT, seed: int = 0) -> np.ndarray:
    """All signatures of a set: any set linked to it, other than an equal one, has one of them.

    Up to three elements apart, the domain is one part of k + 3 cells and every three cells make a signature. Beyond that there
    are k // 2 + 1 parts and some to spare, of three cells each, and every two cells of a part make one. When these two are empty the third
    cell would stand for nothing, so it is told apart by its content and by its content less each element.

    Of the parts, at most k // 2 differ in more than one element, so with s to spare s + 1 or more do not. Such a part gives linked sets a
    signature in common unless it is thin, with an element in one of them at most. When all are, both sets have s + 1 thin parts in
    common or more, and with three of these, s - 2 or more that follow them: so each three of the first t - s + 2 of a set's t thin parts
    make a signature.
    """
    out = []
    for number, apart, spare in schemes(len(elements), percent):
        parts, cells = (1, apart + 3) if apart <= 3 else (apart // 2 + 1 + spare, CELLS)
        place = mixed(elements + _salt(seed, number))
        value = mixed(elements ^ _ODD)
        cell = ((place >> np.uint64(40)) % np.uint64(parts) * np.uint64(cells) + (place & np.uint64(0xFFFFFFF)) % np.uint64(cells)).astype(np.int64)
        sums = np.zeros(parts * cells, np.uint64)
        np.add.at(sums, cell, value)
        sums = sums.reshape(parts, cells)
        label = _salt(seed, number, apart)
        if parts == 1:
            kept = np.array([sum((int(sums[0, c]) for c in three), 0) & (1 << 64) - 1 for three in combinations(range(cells), 3)], np.uint64)
            out.append(mixed(kept + label + mixed(np.arange(len(kept), dtype=np.uint64) + np.uint64(1))))
            continue
        counts = np.bincount(cell, minlength=parts * cells).reshape(parts, cells)
        held = counts.sum(axis=1)
        kept = sums.sum(axis=1, dtype=np.uint64)[:, None] - sums
        alone = (held[:, None] == counts) & (counts > 0)
        names = mixed(np.arange(parts * cells, dtype=np.uint64) + np.uint64(1)).reshape(parts, cells) + label
        full = held[:, None] > counts
        out.append(mixed(kept[full] + names[full]))
        for part, only in zip(*np.nonzero(alone)):
            content = sums[part, only]
            own = value[cell == part * cells + only] if held[part] > 1 else value[:0]
            out.append(mixed(np.append(content, content - own) * _ODD + names[part, only]))
        thin = np.flatnonzero(held <= 1)
        if len(thin) > spare:
            threes = np.array(list(combinations(names[thin[: len(thin) - spare + 2], 0], 3)), np.uint64)
            out.append(mixed(mixed(mixed(threes[:, 0]) + threes[:, 1]) + threes[:, 2]))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def sketch(elements: np.ndarray) -> bytes:
    """Parity of the number of elements in each of a power of two of buckets, one or two per element (256 to 4096).

    Sets with nothing in common then differ in about half the buckets, over twice as many as linked ones may. It travels with every
    signature of a group, so more buckets cost more than the few pairs they would tell apart.
    """
    size = 256
    while size < len(elements) and size < 4096:
        size *= 2
    bits = np.bincount((mixed(elements * _ODD) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def least_apart(a: bytes, b: bytes) -> int:
    """A number of elements that the sets of two sketches are apart at least: each such element flips one parity."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def may_link(size_a: int, sketch_a: bytes, size_b: int, sketch_b: bytes, percent: int = PERCENT) -> bool:
    small, large = sorted((size_a, size_b))
    return 100 * small >= percent * large and least_apart(sketch_a, sketch_b) <= most_apart(size_a + size_b, percent)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def classes(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """(row columns, n_shingles, class, sigs, sketch) of rows with a `text`, which is dropped: one pass that splits and hashes each text once.

    No words: 0 shingles and a null class. `sigs` are the class's signatures and `sketch` is its sketch; null on rows whose set was met
    before in their stretch of rows, so that copies next to each other carry them once.
    """
    kept = [c for c in rows.columns if c != "text"]
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()

        def made(
            batch: pa.RecordBatch, sizes: list[int], names: list[int | None], sigs: list[np.ndarray | None], bits: list[bytes | None]
        ) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {c: batch[c] for c in kept} | {"n_shingles": pa.array(sizes, pa.int64()), "class": pa.array(names, pa.int64()),
                 "sigs": pa.array([None if s is None else s.view(np.int64) for s in sigs], pa.list_(pa.int64())),
                 "sketch": pa.array(bits, pa.binary())})

        for batch in batches(parts, rows=2000, chars=1 << 22):
            sizes, names, sigs, bits, start, held = [], [], [], [], 0, 0
            if len(seen) > 1 << 17:
                seen.clear()
            for text in batch["text"].to_pylist():
                elements = shingles(text, hashes, n)
                name = digest(elements) if len(elements) else None
                sizes.append(len(elements))
                names.append(name)
                fresh = name is not None and name not in seen
                sigs.append(signatures(elements, percent) & SIGNATURE_MASK if fresh else None)
                bits.append(sketch(elements) if fresh else None)
                seen.add(name)
                held += 0 if sigs[-1] is None else len(sigs[-1])
                # Cut by signatures, of which a text has a number that grows with its length and with the threshold.
                if held > BATCH_SIGNATURES:
                    yield made(batch.slice(start, len(sizes)), sizes, names, sigs, bits)
                    start += len(sizes)
                    sizes, names, sigs, bits, held = [], [], [], [], 0
            yield made(batch.slice(start, len(sizes)), sizes, names, sigs, bits)

    return rows.mapInArrow(read, ", ".join(filter(None, [kinds, "n_shingles long, class long, sigs array<long>, sketch binary"])))


def _kept(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """`classes` written, by a codec that leaves out the empty bits of signatures."""
    return saved(spark, rows, "partenum-classes", compression="zstd")


def _elements(spark: SparkSession, texts: DataFrame, made: DataFrame, n: int, ids: DataFrame) -> DataFrame:
    """(id, elements) of the classes in `ids`, each read from one of its texts again: whole sets are wanted of few classes.

    A bit per hash of such a text, in a filter of fixed size, tells most other texts apart before they are split; the join is exact.
    """
    wanted = made.where("class IS NOT NULL").groupBy(F.col("class").alias("id")).agg(F.min("copy").alias("copy")).join(ids, "id", "left_semi")
    bit = F.col("copy").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    lanes = wanted.groupBy(F.shiftright(bit, 5).cast("int").alias("lane")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(copy & 31 AS INT))")).alias("bits")
    ).toPandas()
    table = np.zeros(1 << FILTER_BITS - 5, np.int64)
    table[lanes["lane"].to_numpy(dtype=np.int64)] = lanes["bits"].to_numpy(dtype=np.int64)
    shared = spark.sparkContext.broadcast(table)

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, filled = WordHashes(), set(), shared.value
        for batch in batches(parts, rows=2000, chars=1 << 22):
            low = batch["copy"].to_numpy() & ((1 << FILTER_BITS) - 1)
            batch = batch.filter(pa.array((filled[low >> 5] >> (low & 31) & 1).astype(bool)))
            names, sets = [], []
            if len(seen) > 1 << 17:
                seen.clear()
            for text in batch["text"].to_pylist():
                elements = shingles(text, hashes, n)
                name = digest(elements) if len(elements) else None
                if name is not None and name not in seen:
                    seen.add(name)
                    names.append(name)
                    sets.append(elements.view(np.int64))
            yield pa.RecordBatch.from_pydict({"id": pa.array(names, pa.int64()), "elements": pa.array(sets, pa.list_(pa.int64()))})

    found = texts.select("text", F.xxhash64("text").alias("copy")).mapInArrow(read, "id long, elements array<long>")
    return saved(spark, found.join(ids, "id", "left_semi").dropDuplicates(["id"]), "partenum-elements")


def _verified(spark: SparkSession, pairs: DataFrame, sets: DataFrame, percent: int, elements: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The (a, b) of `pairs` that are linked: sizes and sketches first, then the sets themselves, which are read for what is left."""

    def rough(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            fits = [may_link(*r, percent=percent) for r in zip(*(batch[c].to_pylist() for c in ("size_a", "sketch_a", "size_b", "sketch_b")))]
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    def exact(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts, chars=1 << 24):
            sides = []
            for c in ("elements_a", "elements_b"):
                cuts, values = batch[c].offsets.to_numpy(), batch[c].values.to_numpy()
                sides.append([values[x:y] for x, y in zip(cuts[:-1], cuts[1:])])
            yield batch.select(["a", "b"]).filter(pa.array([linked(x, y, percent) for x, y in zip(*sides)], pa.bool_()))

    def beside(own: DataFrame, rows: DataFrame) -> DataFrame:
        columns = [c for c in own.columns if c != "id"]
        for side in ("a", "b"):
            rows = rows.join(own.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
        return rows.select("a", "b", *[f"{c}_{side}" for c in columns for side in ("a", "b")])

    near = saved(spark, beside(sets, pairs).mapInArrow(rough, "a long, b long"), "partenum-near")
    if near.isEmpty():
        return near
    whole = elements(near.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    return saved(spark, beside(whole, near).mapInArrow(exact, "a long, b long"), "partenum-links")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(id, label): the smallest id of each node's component, for nodes with edges.

    Every node takes the smallest label around it, then the label of its label, until none changes.
    """
    both = edges.where("a != b").select("a", "b").union(edges.where("a != b").select("b", "a")).distinct()
    both = saved(spark, both.toDF("id", "near"), "partenum-edges")
    labels = saved(spark, both.groupBy("id").agg(F.least(F.col("id"), F.min("near")).alias("label")), "partenum-labels")
    while True:
        around = both.join(labels.select(F.col("id").alias("near"), F.col("label").alias("other")), "near")
        around = around.groupBy("id").agg(F.min("other").alias("other"))
        lower = labels.join(around, "id").select("id", "label", F.least("label", "other").alias("lower"))
        hop = labels.select(F.col("id").alias("lower"), F.col("label").alias("beyond"))
        after = lower.join(hop, "lower", "left").select("id", F.least("lower", F.coalesce("beyond", "lower")).alias("after"), "label")
        after = saved(spark, after, "partenum-labels")
        labels = after.select("id", F.col("after").alias("label"))
        if after.where("after != label").isEmpty():
            return labels


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("id"))
    return rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def _divided(spark: SparkSession, rows: DataFrame, most: int) -> DataFrame:
    """(sig, id, label) of signature groups with more than one component; those above `most` rows dealt, so that groups stay below that.

    A large group is dealt into parts of half as many rows, and each two of its parts are a group: every two members meet.
    """
    groups = rows.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")).where("low < high")
    rows = saved(spark, rows.join(groups.select("sig", "n"), "sig"), "partenum-open")
    parts = F.ceil(2 * F.col("n") / F.lit(most))
    large = rows.where(F.col("n") > most).withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).where("other != part")
    large = large.select(F.xxhash64("sig", F.least("part", "other"), F.greatest("part", "other")).alias("sig"), "id", "label")
    return rows.where(F.col("n") <= most).select("sig", "id", "label").unionByName(large)


def _candidates(members: list[tuple[int, int, int, bytes]], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, places j) of the members of other components that member i may be linked to; each pair comes once.

    Pairs are met from the side of the shorter sketch, to which the other is folded.
    """
    if len(members) < WIDE_ROWS:
        for i, (_, la, size_a, bits_a) in enumerate(members):
            found = [j for j in range(i) if members[j][1] != la and may_link(size_a, bits_a, members[j][2], members[j][3], percent)]
            if found:
                yield i, np.array(found)
        return
    label = np.array([m[1] for m in members])
    size = np.array([m[2] for m in members])
    long = np.array([len(m[3]) for m in members])
    for length in np.unique(long):
        wide = np.flatnonzero(long >= length)
        bits = np.zeros((len(wide), length // 8), np.uint64)
        for row, at in enumerate(wide):
            bits[row] = np.bitwise_xor.reduce(np.frombuffer(members[at][3], np.uint64).reshape(-1, length // 8), axis=0)
        for row in np.flatnonzero(long[wide] == length):
            i = wide[row]
            small, large = np.minimum(size[wide], size[i]), np.maximum(size[wide], size[i])
            own = np.flatnonzero(((long[wide] > length) | (wide < i)) & (label[wide] != label[i]) & (100 * small >= percent * large))
            apart = np.bitwise_count(bits[own] ^ bits[row]).sum(axis=1, dtype=np.int64)
            found = wide[own[apart <= (100 - percent) * (size[wide[own]] + size[i]) // (100 + percent)]]
            if len(found):
                yield int(i), found


def _joins(root: np.ndarray, i: int, places: np.ndarray) -> np.ndarray:
    """One of `places` for each component there that is not the one of i; these then are one in `root`."""
    apart, first = np.unique(root[places], return_index=True)
    other = apart != root[i]
    if other.any():
        root[np.isin(root, apart[other])] = root[i]
    return places[first[other]]


def _across(spark: SparkSession, rows: DataFrame, sets: DataFrame, percent: int, forest: bool) -> DataFrame:
    """(a, b, dense): pairs of one signature group and different components whose sketches allow a link.

    With `forest`, of each group only as many as join its components; the rest would tell nothing new if these are links. Without, a group
    with more than twice as many pairs as members is dense: of it only as many as connect all that are in such pairs, for `_dense_links`.
    A group so never gives more than two rows a member.
    """

    def pairs(members: list[tuple[int, int, int, bytes]]) -> Iterator[tuple[int, int, bool]]:
        names, root = [m[0] for m in members], None
        every, tree, dense = [], [], False
        for i, places in _candidates(members, percent):
            if root is None:
                root = np.unique([m[1] for m in members], return_inverse=True)[1] if forest else np.arange(len(members))
            tree += [(i, j) for j in _joins(root, i, places)]
            if not forest and not dense:
                every += [(i, j) for j in places]
                dense = len(every) > 2 * len(members)
        for i, j in tree if forest or dense else every:
            yield min(names[i], names[j]), max(names[i], names[j]), dense

    def made(found: list[tuple[int, int, bool]]) -> pa.RecordBatch:
        kinds = {"a": pa.int64(), "b": pa.int64(), "dense": pa.bool_()}
        return pa.RecordBatch.from_pydict({c: pa.array([p[i] for p in found], kind) for i, (c, kind) in enumerate(kinds.items())})

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current, found = [], None, set()
        for batch in parts:
            for sig, *member in zip(*(batch[c].to_pylist() for c in ("sig", "id", "label", "size", "sketch"))):
                if sig != current:
                    # A pair shares many signatures: it is told once a stretch of groups.
                    found.update(pairs(held))
                    held, current = [], sig
                    if len(found) >= PAIR_ROWS:
                        yield made(list(found))
                        found.clear()
                held.append(tuple(member))
        found.update(pairs(held))
        yield made(list(found))

    beside = rows.distinct().join(sets.select("id", "size", "sketch"), "id")
    grouped = beside.repartition("sig").sortWithinPartitions("sig", "id")
    return grouped.mapInArrow(compare, "a long, b long, dense boolean").distinct()


def _joined(names: np.ndarray, part: np.ndarray, label: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between the sets of different components, as many as join these; in different parts, if there are two."""
    size = np.array([len(e) for e in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Sets that hold an element stand together; elements that only one set has are in no intersection.
    order = np.argsort(token, kind="stable")
    holders, ends = owner[order], np.cumsum(times)
    cuts = np.append(0, np.cumsum(size))
    two = part.min() != part.max()
    root = np.unique(label, return_inverse=True)[1]
    found = []
    for i in range(len(sets)):
        own = token[cuts[i] : cuts[i + 1]]
        own = own[times[own] > 1]
        if not len(own) or not (root != root[i]).any():
            continue
        common = np.bincount(np.concatenate([holders[ends[t] - times[t] : ends[t]] for t in own]), minlength=len(sets))
        near = (100 * common >= percent * (size + size[i] - common)) & (root != root[i])
        if two:
            near &= part != part[i]
        found += [(int(min(names[i], names[j])), int(max(names[i], names[j]))) for j in _joins(root, i, np.flatnonzero(near))]
    return found


def _dense_links(
    spark: SparkSession, near: DataFrame, labels: DataFrame | None, sets: DataFrame, percent: int, most: int, elements: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Links (a, b) within what the pairs of `near` connect, as many as join its components, each tested on whole sets.

    A cluster is dealt into parts of about `most` classes (fewer if they are large), and each two of its parts are compared in one task, where
    a set is held once, however many signatures it shares.
    """
    clusters = components(spark, near).withColumnRenamed("label", "cluster").join(sets.select("id", "size"), "id")
    clusters = saved(spark, _labelled(clusters, labels), "partenum-clusters")
    parts = F.ceil(F.greatest(F.count("*") / F.lit(most), F.sum("size") / F.lit(PART_ELEMENTS))).alias("parts")
    dealt = clusters.join(clusters.groupBy("cluster").agg(parts), "cluster").withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    dealt = dealt.select("cluster", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "id", "part", "label")

    def compare_sets(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links() -> pa.RecordBatch:
            found = _joined(*(np.array([m[k] for m in held]) for k in range(3)), [m[3] for m in held], percent) if held else []
            return pa.RecordBatch.from_pydict({c: pa.array([p[i] for p in found], pa.int64()) for i, c in enumerate("ab")})

        held, current = [], None
        for batch in batches(batches_, chars=1 << 24):
            cuts, values = batch["elements"].offsets.to_numpy(), batch["elements"].values.to_numpy()
            rows = zip(*(batch[c].to_pylist() for c in ("cluster", "i", "j", "id", "part", "label")))
            for at, (cluster, i, j, *member) in enumerate(rows):
                if (cluster, i, j) != current:
                    yield links()
                    held, current = [], (cluster, i, j)
                held.append((*member, values[cuts[at] : cuts[at + 1]]))
        yield links()

    whole = elements(clusters.select("id"))
    blocks = dealt.join(whole, "id").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "id")
    return saved(spark, blocks.mapInArrow(compare_sets, "a long, b long").distinct(), "partenum-dense")


def _shared(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(sig, id, first) of the signatures that several classes have, `first` being the smallest of these classes.

    Signatures are by far the most of what is shuffled, and few are shared, so they are shuffled a part at a time.
    """
    every, out = Window.partitionBy("sig"), []
    for turn in range(TURNS):
        some = rows.where(F.col("sig").bitwiseAND(F.lit(TURNS - 1)) == turn)
        some = some.withColumn("first", F.min("id").over(every)).withColumn("last", F.max("id").over(every)).where("first < last")
        # Copies that were not next to each other have their signatures more than once.
        out.append(saved(spark, some.select("sig", "id", "first").distinct(), "partenum-shared"))
    return reduce(DataFrame.unionByName, out)


def class_components(
    spark: SparkSession, texts: DataFrame, n: int = SHINGLE, percent: int = PERCENT, group_rows: int = GROUP_ROWS, made: DataFrame | None = None
) -> DataFrame:
    """(id, label) of the classes that are linked to others; `made` are the `classes` of `texts` with `copy`, if already there."""
    if made is None:
        made = _kept(spark, classes(texts.select(F.xxhash64("text").alias("copy"), "text"), n, percent))
    rows = made.where("sigs IS NOT NULL").select(F.explode("sigs").alias("sig"), F.col("class").alias("id"))
    shared = _shared(spark, rows)
    sets = made.where("sketch IS NOT NULL").select(F.col("class").alias("id"), F.col("n_shingles").alias("size"), "sketch")
    sets = saved(spark, sets.join(shared.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"]), "partenum-sets")
    elements = partial(_elements, spark, texts, made, n)
    # Each class against the first of each of its groups.
    links = _verified(spark, shared.where("id != first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct(), sets, percent, elements)
    labels = None if links.isEmpty() else components(spark, links)
    # Then what is still apart: joins that would connect a group's components, and at last every pair that may be a link, those of dense
    # groups by comparing whole sets in place, so that what is written grows with the members of a group and not with their pairs.
    for forest in (True, False):
        rest = _divided(spark, _labelled(shared.select("sig", "id"), labels), group_rows)
        near = saved(spark, _across(spark, rest, sets, percent, forest), "partenum-across")
        more = _verified(spark, near.where("NOT dense").select("a", "b"), sets, percent, elements)
        dense = near.where("dense").select("a", "b")
        if not dense.isEmpty():
            more = more.unionByName(_dense_links(spark, dense, labels, sets, percent, group_rows, elements))
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = components(spark, links)
    return labels if labels is not None else spark.createDataFrame([], "id long, label long")


def near_groups(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, class, label, component_id) of every row: the smallest key its document reaches by links.

    Words are runs of other than ASCII white space with A-Z lower-cased. A document without words or text has no shingle, links
    with nothing and is its own component; fewer words than a shingle are one shingle. Repeated rows and copies are linked. Rows without a key
    take part, and a component of only such rows has a null id.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    made = _kept(spark, classes(rows.select("id", F.xxhash64("text").alias("copy"), "text"), n, percent))
    labels = class_components(spark, rows.select("text"), n, percent, made=made)
    own = made.select("id", "n_shingles", "class")
    # From here on a class is a row, so a large group of copies is one row until its documents are looked up.
    by_class = own.where("class IS NOT NULL").groupBy("class").agg(F.min("id").alias("least"))
    by_class = by_class.join(labels.withColumnRenamed("id", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
    by_class = saved(spark, by_class, "partenum-labelled")
    least = by_class.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = by_class.join(least, "label").select("class", "label", "component_id")
    out = own.join(ids, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(key), "n_shingles", "class", "label", component.alias("component_id"))


def one_of_each(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` that stay when of each component only one document does: that with the smallest key.

    Documents without words stay. Rows of one key are told apart by their text; of rows with equal key and text one stays, and of
    texts that share the smallest key of their component the one with the smallest digest.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    bare = F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]")) == 0
    rows = packed(docs, key=F.col(f"`{key}`"), digest=F.md5(body), bare=bare, text=F.col(f"`{text}`"))
    groups = saved(spark, near_groups(spark, rows.select(F.struct("key", "digest").alias("doc"), "text"), "doc", "text", n, percent), "partenum-groups")
    kept = groups.where("doc = component_id AND class IS NOT NULL").groupBy("doc.key", "doc.digest").agg(F.count("*").alias("times"))
    k = saved(spark, kept, "partenum-kept").alias("k")
    d = rows.drop("text").alias("d")
    found = d.where("NOT bare").join(k, F.col("d.key").eqNullSafe(F.col("k.key")) & (F.col("d.digest") == F.col("k.digest"))).select("d.*", "times")
    # Repeated rows are few: only they are shuffled to find one of each.
    repeated = found.where("times > 1").dropDuplicates(["key", "digest"])
    return found.where("times = 1").select("row.*").unionByName(repeated.select("row.*")).unionByName(rows.where("bare").select("row.*"))
