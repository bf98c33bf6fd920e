"""Small helpers that several operators share."""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtab.session import scratch_path

# Words are runs of anything but space, tab, LF, VT, FF, CR; bytes.split() cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
# Whether a query's shuffle files go when it ends.
CLEARS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LOWER_ASCII = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, A-Z lower-cased; none for null."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER_ASCII).split() if text else []


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The `words` of all texts in a row, and how many there are before each text and in all; made by Arrow without an object a word."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string()).fill_null("")))
    found, cuts = lists.values, lists.offsets.to_numpy()
    # White space at the edges of a text leaves an empty piece there.
    full = pc.binary_length(found).to_numpy() > 0
    if full.all():
        return found, cuts.astype(np.int64)
    return found.filter(pa.array(full)), np.append(0, np.cumsum(full))[cuts]


@contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files: else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEARS, None)
    spark.conf.set(CLEARS, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEARS)
        else:
            spark.conf.set(CLEARS, before)


def saved(spark: SparkSession, df: DataFrame, label: str, **options: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read back, which cuts its lineage; its shuffle files go."""
    path = scratch_path(spark, label)
    with shuffles_cleared(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns of `df` as one, `row`, beside new ones, whose names can then clash with none; `row.*` brings them back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(name) for name, c in columns.items()])


def batches(columns: Iterator[pa.RecordBatch], rows: int = 0, chars: int = 0) -> Iterable[pa.RecordBatch]:
    """Record batches cut to at most `rows` rows and, by string column, about `chars` bytes (0: no bound)."""
    for batch in columns:
        step = batch.num_rows
        if rows:
            step = min(step, rows)
        if chars and batch.nbytes > chars:
            step = min(step, max(1, batch.num_rows * chars // batch.nbytes))
        for start in range(0, batch.num_rows, max(1, step)):
            yield batch.slice(start, step)
