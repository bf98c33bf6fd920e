"""Near-duplicate documents by MinHash, banding, verification and star-alternating components.

A document is the set of its distinct word shingles, and its signature the least value of each of 128 universal hash functions over
that set. Four minima in a row make a band; two documents that share a band are candidates. At 85 % a pair misses all
32 bands with probability 5e-11. Candidates are compared by their signatures and by parity sketches, whose distance is a lower bound
of the number of elements two sets differ in, then by their whole sets, so no link is wrong.

Documents with equal sets are one class (a 64-bit digest of the set), and classes are what is compared. A bucket of a
band is never expanded into its pairs: its members are first compared with one of them only, and afterwards only members that
are still in different components meet, in blocks of bounded size, large buckets after division by longer bands.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtab.llm.common import batches, saved, words
from streamtab.llm.hashing import WordHashes, grams, mixed

SHINGLE = 5
# Linked when 100 * intersection >= PERCENT * union.
PERCENT = 85
HASHES = 128
ROWS = 4
BANDS = HASHES // ROWS
# Longer bands that divide large buckets, and minima in one of them.
LONG_BANDS, LONG_ROWS = 160, 8
# A linked pair with fewer equal minima than the signature test asks for is as rare as this.
RISK = 1e-9
# Members of one bucket that one task compares with as many others at a time.
BLOCK = 2048
FILTER_BITS = 24
# Shingles hashed at a time: what a core's cache holds.
_STRETCH = 1 << 14
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=None)
def hash_family(count: int = HASHES, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Factors and addends of multiply-shift hashing: (a * x + b) mod 2^64 >> 32 is pairwise independent over 32-bit x."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 64, count, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 64, count, dtype=np.uint64)


@lru_cache(maxsize=None)
def long_bands(seed: int = 12) -> np.ndarray:
    """Which minima make each of the longer bands."""
    rng = np.random.default_rng(seed)
    return np.stack([rng.choice(HASHES, LONG_ROWS, replace=False) for _ in range(LONG_BANDS)])


@lru_cache(maxsize=None)
def least_equal(percent: int = PERCENT, hashes: int = HASHES, risk: float = RISK) -> int:
    """Equal minima that a pair at the threshold has, but with probability `risk`."""
    p, tail = percent / 100, 0.0
    for k in range(hashes + 1):
        tail += comb(hashes, k) * p**k * (1 - p) ** (hashes - k)
        if tail > risk:
            return k
    return hashes


def shingles(text: str | None, hashes: WordHashes, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; the whole sequence is one when there are fewer words."""
    found = words(text)
    return np.unique(grams(hashes.of(found), min(n, len(found)))) if found else np.empty(0, np.uint64)


def digest(elements: np.ndarray) -> int:
    """64-bit digest of a sorted set, signed as Spark's long."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(elements.tobytes())).astype(np.int64))


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, hashes) least hash values of non-empty sets."""
    factors, addends = hash_family()
    out, start = np.empty((len(sets), HASHES), np.uint32), 0
    while start < len(sets):
        stop, total = start + 1, len(sets[start])
        while stop < len(sets) and total + len(sets[stop]) <= _STRETCH:
            total += len(sets[stop])
            stop += 1
        keys = np.concatenate(sets[start:stop]) >> np.uint64(32)
        cuts = np.cumsum([0] + [len(s) for s in sets[start : stop - 1]])
        values = np.empty_like(keys)
        for j in range(HASHES):
            np.multiply(keys, factors[j], out=values)
            values += addends[j]
            out[start:stop, j] = np.minimum.reduceat(values, cuts) >> np.uint64(32)
        start = stop
    return out


def bands(signatures: np.ndarray) -> np.ndarray:
    """(sets, bands) keys of the groups of four minima."""
    halves = signatures.view(np.uint64).reshape(len(signatures), BANDS, ROWS // 2)
    total = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX), halves.shape[:2])
    for i in range(ROWS // 2):
        total = mixed((total + halves[:, :, i]) * _MIX)
    return total


def sketch(elements: np.ndarray) -> bytes:
    """Parity of the number of elements in each of a power of two of bits, two to four an element (256 to 16384)."""
    size = min(max(256, 1 << (2 * len(elements)).bit_length()), 16384)
    bits = np.bincount((mixed(elements * _MIX) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A sketch, or a matrix of them, of 64-bit words as the shorter sketch that the same elements make."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def may_link(sizes: tuple[int, int], sketches: tuple[bytes, bytes], percent: int = PERCENT) -> bool:
    """Whether two sets can be linked: every element that only one of them has flips one parity."""
    a, b = (np.frombuffer(x, np.uint64) for x in sketches)
    words = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, words) ^ folded(b, words)).sum()) * (100 + percent) <= (100 - percent) * sum(sizes)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """One list per row of a matrix."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.reshape(-1), kind))


def banded(rows: DataFrame, n: int) -> DataFrame:
    """(id, n_shingles, class, bands) of rows (id, text); no words: 0 shingles, null class and bands.

    A class is banded once per stretch of rows; its later rows have null bands.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in batches(parts, rows=2000, chars=1 << 22):
            sizes, names, fresh, places = [], [], [], []
            if len(seen) > 1 << 17:
                seen.clear()
            for i, text in enumerate(batch["text"].to_pylist()):
                elements = shingles(text, hashes, n)
                sizes.append(len(elements))
                names.append(digest(elements) if len(elements) else None)
                if len(elements) and names[-1] not in seen:
                    seen.add(names[-1])
                    fresh.append(elements)
                    places.append(i)
            lists = pa.nulls(len(sizes), pa.list_(pa.int64()))
            if fresh:
                where = np.full(len(sizes), -1)
                where[places] = np.arange(len(places))
                lists = _lists(bands(minima(fresh)).view(np.int64), pa.int64()).take(pa.array(where, mask=where < 0))
            yield pa.RecordBatch.from_pydict(
                {"id": batch["id"], "n_shingles": pa.array(sizes, pa.int64()), "class": pa.array(names, pa.int64()), "bands": lists}
            )

    return rows.mapInArrow(read, f"id {kind}, n_shingles long, class long, bands array<long>")


def _members(spark: SparkSession, texts: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """(class, size, signature, sketch, elements) of the wanted classes.

    A filter of fixed size, a bit per wanted class, tells most other texts apart; the join that follows is exact.
    """
    bit = F.col("class").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    lanes = classes.groupBy(F.shiftright(bit, 5).cast("int").alias("lane")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(class & 31 AS INT))")).alias("bits")
    ).toPandas()
    table = np.zeros(1 << FILTER_BITS - 5, np.int64)
    table[lanes["lane"].to_numpy(dtype=np.int64)] = lanes["bits"].to_numpy(dtype=np.int64)
    shared = spark.sparkContext.broadcast(table)

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, filled = WordHashes(), set(), shared.value
        for batch in batches(parts, rows=1000, chars=1 << 22):
            names, sets = [], []
            if len(seen) > 1 << 17:
                seen.clear()
            for text in batch["text"].to_pylist():
                elements = shingles(text, hashes, n)
                if not len(elements):
                    continue
                name = digest(elements)
                low = name & (1 << FILTER_BITS) - 1
                if name not in seen and filled[low >> 5] >> (low & 31) & 1:
                    seen.add(name)
                    names.append(name)
                    sets.append(elements)
            if names:
                yield pa.RecordBatch.from_pydict({
                    "class": pa.array(names, pa.int64()), "size": pa.array([len(s) for s in sets], pa.int64()),
                    "signature": _lists(minima(sets).view(np.int32), pa.int32()), "sketch": pa.array([sketch(s) for s in sets], pa.binary()),
                    "elements": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))})

    kinds = "class long, size long, signature array<int>, sketch binary, elements array<long>"
    found = texts.mapInArrow(read, kinds).join(classes, "class", "left_semi")
    return saved(spark, found.dropDuplicates(["class"]), "minhash-members")


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _verified(spark: SparkSession, pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of `pairs` that are linked: by sizes, signatures and sketches first, then by the sets themselves."""
    enough = least_equal(percent)

    def alike(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if batch.num_rows:
                small, large = (f(batch["size_a"].to_numpy(), batch["size_b"].to_numpy()) for f in (np.minimum, np.maximum))
                equal = (_matrix(batch["signature_a"]) == _matrix(batch["signature_b"])).sum(axis=1)
                fits = (100 * small >= percent * large) & (equal >= enough)
                facts = (batch[c].to_pylist() for c in ("size_a", "size_b", "sketch_a", "sketch_b"))
                fits &= np.fromiter((may_link(f[:2], f[2:], percent) for f in zip(*facts)), bool, batch.num_rows)
                yield batch.select(["a", "b"]).filter(pa.array(fits))

    def exact(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts, chars=1 << 24):
            sides = []
            for c in ("elements_a", "elements_b"):
                cuts, values = batch[c].offsets.to_numpy(), batch[c].values.to_numpy()
                sides.append([values[x:y].view(np.uint64) for x, y in zip(cuts[:-1], cuts[1:])])
            yield batch.select(["a", "b"]).filter(pa.array([linked(x, y, percent) for x, y in zip(*sides)], pa.bool_()))

    def beside(columns: list[str], rows: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            rows = rows.join(members.select(F.col("class").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
        return rows.select("a", "b", *[f"{c}_{side}" for c in columns for side in ("a", "b")])

    near = saved(spark, beside(["size", "signature", "sketch"], pairs).mapInArrow(alike, "a long, b long"), "minhash-near")
    return saved(spark, beside(["elements"], near).mapInArrow(exact, "a long, b long"), "minhash-links")


def star_components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(id, label) of nodes with links: the smallest node of their component.

    Large-star joins every larger neighbour of a node to the smallest node around it, small-star every smaller neighbour and the node
    itself. They alternate until the edges stay the same, which are then stars around each component's smallest node.
    """

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first())

    edges = links.where("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges = saved(spark, edges, "minhash-edges")
    before = state(edges)
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = saved(spark, large, "minhash-edges")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        small = small.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
        edges = saved(spark, small, "minhash-edges")
        after = state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("hi").alias("id"), F.col("lo").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("id"), "label").distinct())


def _apart(rows: DataFrame) -> DataFrame:
    """(bucket, class, label, n) of the buckets that hold classes of different components."""
    groups = rows.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")).where("low < high")
    return rows.join(groups.select("bucket", "n"), "bucket")


def _divided(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of large buckets under the longer bands of their members: linked members share one of these too, but with the documented risk."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = long_bands()
        for batch in batches(parts, rows=256):
            if not batch.num_rows:
                continue
            signatures = _matrix(batch["signature"]).view(np.uint32).astype(np.uint64)
            total = batch["bucket"].to_numpy().view(np.uint64)[:, None] + mixed(np.arange(1, LONG_BANDS + 1, dtype=np.uint64) * _MIX)
            for i in range(LONG_ROWS):
                total = mixed((total + signatures[:, chosen[:, i]]) * _MIX)
            repeat = np.repeat(np.arange(batch.num_rows), LONG_BANDS)
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array(total.reshape(-1).view(np.int64)), "class": batch["class"].take(pa.array(repeat)), "label": batch["label"].take(pa.array(repeat))}
            )

    beside = rows.select("bucket", "class", "label").join(members.select("class", "signature"), "class").select("bucket", "class", "label", "signature")
    return beside.mapInArrow(read, "bucket long, class long, label long")


def _across(spark: SparkSession, rows: DataFrame, members: DataFrame, percent: int, forest: bool, block: int) -> DataFrame:
    """Pairs of one bucket and different components whose sizes, signatures and sketches allow a link.

    A bucket is dealt into blocks of about `block` members; every two of its blocks meet in one task. With `forest`, of the pairs found
    there only as many are named as connect their components.
    """
    enough = least_equal(percent)
    rows = saved(spark, _apart(rows), "minhash-open")
    if not rows.where(F.col("n") > block).isEmpty():
        finer = _apart(_divided(rows.where(F.col("n") > block), members).distinct())
        rows = saved(spark, rows.where(F.col("n") <= block).unionByName(finer), "minhash-open")
    dealt = rows.withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "class", "label")
    dealt = dealt.join(members.select("class", "size", "sketch", "signature"), "class")

    def pairs(held: list[tuple]) -> Iterator[tuple[int, int]]:
        own, names, labels, sizes = (np.array(c) for c in list(zip(*held))[:4])
        signatures = np.stack([h[5] for h in held])
        widths = np.array([len(h[4]) // 8 for h in held])
        # Sketches of each width and of wider ones, folded to it.
        sketches, places = {}, {}
        for width in np.unique(widths):
            wide = np.flatnonzero(widths >= width)
            sketches[width] = np.stack([folded(np.frombuffer(held[i][4], np.uint64), width) for i in wide])
            places[width] = np.full(len(held), -1)
            places[width][wide] = np.arange(len(wide))
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        left, right = (np.arange(len(own)),) * 2 if own.min() == own.max() else (np.flatnonzero(own == own.min()), np.flatnonzero(own == own.max()))
        for a in left:
            other = right[(labels[right] != labels[a]) & (100 * np.minimum(sizes[right], sizes[a]) >= percent * np.maximum(sizes[right], sizes[a]))]
            if left is right:
                other = other[other > a]
            other = other[(signatures[other] == signatures[a]).sum(axis=1) >= enough]
            shared = np.minimum(widths[other], widths[a])
            for width in np.unique(shared):
                some = other[shared == width]
                flipped = np.bitwise_count(sketches[width][places[width][some]] ^ sketches[width][places[width][a]]).sum(axis=1, dtype=np.int64)
                for b in some[flipped * (100 + percent) <= (100 - percent) * (sizes[some] + sizes[a])]:
                    if forest:
                        x, y = find(int(labels[a])), find(int(labels[b]))
                        if x == y:
                            continue
                        root[x] = y
                    yield min(names[a], names[b]), max(names[a], names[b])

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in parts:
            found = []
            if batch.num_rows:
                keys = zip(*(batch[c].to_pylist() for c in ("bucket", "i", "j")))
                facts = zip(*(batch[c].to_pylist() for c in ("own", "class", "label", "size", "sketch")), _matrix(batch["signature"]).copy())
                for key, fact in zip(keys, facts):
                    if key != current:
                        found += pairs(held) if held else ()
                        held, current = [], key
                    held.append(fact)
            yield pa.RecordBatch.from_pydict({c: pa.array([int(p[i]) for p in found], pa.int64()) for i, c in enumerate("ab")})
        found = list(pairs(held)) if held else []
        yield pa.RecordBatch.from_pydict({c: pa.array([int(p[i]) for p in found], pa.int64()) for i, c in enumerate("ab")})

    grouped = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return grouped.mapInArrow(compare, "a long, b long").distinct()


def class_components(spark: SparkSession, own: DataFrame, texts: DataFrame, n: int, percent: int, block: int = BLOCK) -> DataFrame:
    """(id, label) of the classes of `own` (class, bands) that are linked to others."""
    rows = own.where("bands IS NOT NULL").select("class", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("class").alias("first"), F.max("class").alias("last")).where("first < last")
    shared = saved(spark, rows.join(shared.select("bucket", "first"), "bucket"), "minhash-shared")
    members = _members(spark, texts, shared.select("class").distinct(), n)
    pairs = shared.where("class != first").select(F.col("first").alias("a"), F.col("class").alias("b")).distinct()
    links = _verified(spark, pairs, members, percent)
    labels = star_components(spark, links)
    # What is still apart: pairs that would connect a bucket's components, and at last every pair that may be a link.
    for forest in (True, False):
        known = labels.select(F.col("id").alias("class"), "label")
        rest = shared.select("bucket", "class").distinct().join(known, "class", "left").withColumn("label", F.coalesce("label", "class"))
        more = _verified(spark, _across(spark, rest, members, percent, forest, block), members, percent)
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = star_components(spark, links)
    return labels


def near_copies(
    spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK
) -> DataFrame:
    """(key, n_shingles, class, component_id, kept) of every row: the smallest key it reaches by links, and whether that is its own.

    Words are runs of other than ASCII white space with A-Z lower-cased. A document without words or text has no shingle, links
    with nothing and is its own component; fewer words than a shingle are one shingle. Repeated rows are copies of each
    other and all kept when theirs is the smallest key. Rows without a key take part; a component of only such rows has a null id, and
    they are kept only where they have no words or where their component has no key.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    own = saved(spark, banded(rows, n), "minhash-classes")
    labels = class_components(spark, own.select("class", "bands"), rows.select("text"), n, percent, block)
    # From here on a class is a row, so a large group of copies is one row until its documents are looked up.
    by_class = own.where("class IS NOT NULL").groupBy("class").agg(F.min("id").alias("least"))
    by_class = by_class.join(labels.withColumnRenamed("id", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
    by_class = saved(spark, by_class, "minhash-labelled")
    least = by_class.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = by_class.join(least, "label").select("class", "component_id")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    out = own.join(ids, "class", "left").select("id", "n_shingles", "class", component.alias("component_id"))
    return out.select(F.col("id").alias(key), "n_shingles", "class", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
