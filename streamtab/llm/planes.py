"""Centroid clustering of whole-number vectors by bit planes.

A vector of 64 components is stored as one 64-bit word per bit of its components: plane p holds bit p of each of them, the last
plane the sign. A dot product is then a weighted sum of popcounts: over all pairs of planes, 2^p * 2^q times the number
of components whose bits p and q are both set, the weight of a sign plane being negative. Dot products, squared distances
and sums are whole numbers, so a result does not depend on the order or the partitioning of the rows.

The planes are made once and read by every round. A round sends the centroids to the tasks and brings back one row of sums per
cluster; nothing that grows with the table passes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtab.llm.common import batches, saved

COMPONENTS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
# Whole numbers below this in size keep every squared distance within 64 bits.
LIMIT = 1 << 27
ROWS = 4096


def usable(vector: Column) -> Column:
    """Whether a vector has exactly 64 components, none of them null, infinite or not a number."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) == COMPONENTS) & finite, F.lit(False))


def whole(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of doubles, as whole numbers."""
    scaled = np.floor(scale * vectors)
    if scaled.size and np.abs(scaled).max() >= LIMIT:
        raise ValueError(f"a component of {LIMIT} or more after scaling: squared distances would not fit 64 bits")
    return scaled.astype(np.int64)


def pack(values: np.ndarray) -> np.ndarray:
    """(rows, planes) of a matrix of whole numbers with 64 columns, in two's complement, with as many planes as its values need."""
    reach = int(max(values.max(initial=0), (~values).max(initial=0)))
    out = np.empty((len(values), reach.bit_length() + 1), np.uint64)
    for p in range(out.shape[1]):
        bits = (values >> p & 1).astype(np.uint8)
        out[:, p] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def weights(planes: int) -> np.ndarray:
    """What a bit of each plane counts; the last is the sign."""
    out = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))
    out[-1] = -out[-1]
    return out


def dot(planes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact dot products of (planes, rows) with the planes of one vector, or row by row with (planes, rows)."""
    own, total = weights(len(planes)), np.zeros(planes.shape[1], np.int64)
    for weight, plane in zip(weights(len(other)), other):
        for mine, row in zip(own, planes):
            total += int(weight * mine) * np.bitwise_count(row & plane).astype(np.int64)
    return total


def unpacked_sum(planes: np.ndarray) -> np.ndarray:
    """Sum over rows of the vectors behind (planes, rows), by component."""
    total = np.zeros(COMPONENTS, np.int64)
    for weight, row in zip(weights(len(planes)), planes):
        bits = np.unpackbits(np.ascontiguousarray(row).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += weight * bits.sum(axis=0, dtype=np.int64)
    return total


def _planes(column: pa.ListArray) -> np.ndarray:
    """(planes, rows) of a list column; rows with fewer planes than others repeat their sign plane."""
    ends, values = column.offsets.to_numpy().astype(np.int64), column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    widths = np.diff(ends)
    place = np.minimum(np.arange(widths.max(initial=1))[:, None], widths - 1) + ends[:-1]
    return values[place]


def nearest(planes: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row, the smaller on ties, and the squared distance."""
    sides = pack(centroids)
    own = (centroids * centroids).sum(axis=1)
    apart = np.stack([norms - 2 * dot(planes, side) + norm for side, norm in zip(sides, own)])
    best = apart.argmin(axis=0)
    return best, np.take_along_axis(apart, best[None], axis=0)[0]


def packed_vectors(spark: SparkSession, rows: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(key, planes, norm) of the usable vectors, written to the shared folder."""
    kept = rows.where(usable(F.col(f"`{vector}`"))).select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    kind = kept.schema["key"].dataType.simpleString()

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts, rows=ROWS):
            column = batch["v"]
            numbers = whole(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), COMPONENTS), scale)
            planes = pack(numbers)
            ends = pa.array(np.arange(len(planes) + 1, dtype=np.int32) * planes.shape[1])
            lists = pa.ListArray.from_arrays(ends, pa.array(planes.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_pydict({"key": batch["key"], "planes": lists, "norm": pa.array(dot(planes.T, planes.T))})

    return saved(spark, kept.mapInArrow(read, f"key {kind}, planes array<long>, norm long"), "planes")


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = 3) -> np.ndarray:
    """The vectors with the smallest SHA-256 of `seed:key`, in that order; equal keys by their planes, a null key last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    picked = vectors.orderBy(digest.asc_nulls_last(), "planes").limit(clusters).select("planes").collect()
    rows = [unpacked_sum(np.array(r["planes"], np.int64).view(np.uint64)[:, None]) for r in picked]
    return np.array(rows, np.int64).reshape(-1, COMPONENTS)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, n, sums) of every task, one row per cluster it has rows of."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), COMPONENTS), np.int64)
        for batch in batches(parts, rows=ROWS):
            planes = _planes(batch["planes"])
            best, _ = nearest(planes, batch["norm"].to_numpy(), centroids)
            for cluster in np.unique(best):
                mine = best == cluster
                counts[cluster] += mine.sum()
                sums[cluster] += unpacked_sum(planes[:, mine])
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"cluster": pa.array(found.astype(np.int32)), "n": pa.array(counts[found]), "sums": pa.array(sums[found].tolist(), pa.list_(pa.int64()))}
        )

    return vectors.select("planes", "norm").mapInArrow(read, "cluster int, n long, sums array<long>")


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor of the mean of their vectors; an empty cluster keeps its centroid."""
    totals = [F.sum(F.col("sums")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(COMPONENTS)]
    out = centroids.copy()
    for row in _sums(vectors, centroids).groupBy("cluster").agg(F.sum("n").alias("n"), *totals).collect():
        out[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(COMPONENTS)]
    return out


def fit(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3) -> np.ndarray:
    """Centroids after `rounds` rounds over packed vectors; fewer than `clusters` vectors make fewer centroids."""
    centroids = first_centroids(vectors, clusters, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids)
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(key, cluster, distance) of packed vectors."""
    kind = vectors.schema["key"].dataType.simpleString()

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts, rows=ROWS):
            best, apart = nearest(_planes(batch["planes"]), batch["norm"].to_numpy(), centroids)
            yield pa.RecordBatch.from_pydict({"key": batch["key"], "cluster": pa.array(best.astype(np.int32)), "distance": pa.array(apart)})

    return vectors.mapInArrow(read, f"key {kind}, cluster int, distance long")


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(
    spark: SparkSession, rows: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS
) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector.

    A row whose vector is null, of another length, or has a null or non-finite component has no result row. Repeated rows count as often as they
    occur, a row without a key takes part and is the last choice for a first centroid. No usable vector: no rows. A
    component of 2^27 or more after scaling is an error, since distances would not fit 64 bits.
    """
    vectors = packed_vectors(spark, rows, key, vector)
    centroids = fit(vectors, clusters, rounds)
    placed = saved(spark, assign(vectors, centroids), "planes-assigned")
    # One number per cluster.
    spread = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    facts = F.array(
        *[F.struct(F.lit(spread.get(i, 0)).cast("long").alias("inertia"), F.lit(centroid_digest(c)).alias("digest")) for i, c in enumerate(centroids)]
    )
    if not len(centroids):
        facts = F.array(F.struct(F.lit(0).cast("long").alias("inertia"), F.lit("").alias("digest")))
    return placed.withColumn("fact", facts[F.col("cluster")]).select(
        F.col("key").alias(key), "cluster", "distance", F.col("fact.inertia").alias("cluster_inertia"),
        F.lit(sum(spread.values())).cast("long").alias("inertia"), F.col("fact.digest").alias("centroid_sha256"),
    )
