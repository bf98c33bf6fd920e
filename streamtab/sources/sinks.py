"""Sinks. Each is safe to replay: a batch written twice leaves what one write leaves. (A plain append without a write id is not.)"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_once(df: DataFrame, path: str, write_id: str | int, fmt: str = "parquet", **options: str) -> None:
    """Add the rows of one write to the table at `path`; a write repeated with its id takes the place of the first.

    Rows go to a folder of their own; a manifest with one entry per id then names it. A write that dies before its entry leaves
    nothing that `read_written` sees, and each entry is overwritten whole.
    """
    folder = f"{path}/rows/{uuid.uuid4().hex}"
    df.write.format(fmt).options(**options).save(folder)
    entry = df.sparkSession.createDataFrame([(str(write_id), folder)], "write_id string, folder string")
    entry.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/{write_id}")


def read_written(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", **options: str) -> DataFrame:
    """The rows of every write that the manifest of `write_once` names."""
    folders = [r["folder"] for r in spark.read.parquet(f"{path}/manifest/*").select("folder").collect()]
    return spark.read.format(fmt).schema(schema).options(**options).load(folders)


def append_csv(df: DataFrame, path: str, checkpoint: str | None = None, write_id: str | int | None = None, **options: str):
    """Append rows as CSV. An updating streaming aggregate is refused by Spark, as it must be.

    A stream keeps its own log of batches. A batch table is safe to replay with a `write_id` (read with `read_written`); without one its rows
    are appended again by every call.
    """
    if df.isStreaming:
        stream = df.writeStream.format("csv").outputMode("append").options(**options)
        return stream.option("checkpointLocation", checkpoint).start(path)
    if write_id is not None:
        return write_once(df, path, write_id, "csv", **options)
    return df.write.mode("append").options(**options).csv(path)


def to_documents(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """One JSON document per row, all values as strings; `mapping` is field name -> column."""
    fields = [F.col(c).cast("string").alias(name) for name, c in mapping.items()]
    return df.select(F.to_json(F.struct(*fields)).alias("value"))


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest whole row of each key; combined map-side, so a hot key costs one row per task."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def upsert_table(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], batch_id: int = 0) -> None:
    """Add one batch of keyed values. The batch's folder is overwritten, so a replayed batch does no harm.

    Cost follows the batch, not the table; `read_latest` resolves the batches, `compact` folds them.
    """
    last_per_key(df, keys, order).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current value per key; between equal `order` values the later batch wins."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    rows = rows.withColumn("batch", F.col("batch").cast("bigint"))
    return last_per_key(rows, keys, [*order, "batch"]).drop("batch")


def compact(spark: SparkSession, path: str, target: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Fold all batches into the first batch of a new table path."""
    read_latest(spark, path, keys, order).write.mode("overwrite").parquet(f"{target}/batch=0")


def upsert_jdbc(
    df: DataFrame, url: str, table: str, staging: str, keys: Sequence[str], order: Sequence[str], **options: str
) -> None:
    """Update by key, insert where the key is new.

    Executors write the last row per key to a staging table; one MERGE inside the database moves it over. The
    MERGE is idempotent, so a retried batch leaves the same table.
    """
    reader = df.sparkSession.read.format("jdbc").option("url", url).options(**options)
    last_per_key(df, keys, order).write.format("jdbc").option("url", url).options(**options).option(
        "dbtable", staging
    ).mode("overwrite").save()
    q = [f'"{c}"' for c in df.columns]
    on = " AND ".join(f'T."{k}" = S."{k}"' for k in keys)
    sets = ", ".join(f'"{c}" = S."{c}"' for c in df.columns if c not in keys)
    merge = (
        f"MERGE INTO {table} T USING {staging} S ON {on} "
        + (f"WHEN MATCHED THEN UPDATE SET {sets} " if sets else "")
        + f"WHEN NOT MATCHED THEN INSERT ({', '.join(q)}) VALUES ({', '.join('S.' + c for c in q)})"
    )
    # The statement runs on the reader's connection before its single partition is read.
    reader.option("dbtable", staging).option("sessionInitStatement", merge).load().foreach(lambda _: None)


def write_tagged(df: DataFrame, path: str, tag: str = "tag", fmt: str = "parquet") -> None:
    """Write the rows of each tag to its own folder `path/tag=...`, in one pass over the input."""
    df.write.mode("overwrite").partitionBy(tag).format(fmt).save(path)


def write_tagged_stream(df: DataFrame, path: str, checkpoint: str, tag: str = "tag"):
    """Streaming form: every micro-batch owns a folder, split by tag."""

    def save(batch: DataFrame, batch_id: int) -> None:
        write_tagged(batch, f"{path}/batch={batch_id}", tag)

    return df.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)


def write_tags(df: DataFrame, sinks: dict[str, tuple[str, str]], write_id: str | int, tag: str = "tag") -> None:
    """Each tag to a sink of its own: tag -> (format, path). The rows are computed once; a repeated `write_id` changes nothing.

    Rows of a tag without a sink, or of none, are an error before anything is written.
    """
    rows = df.persist()
    try:
        other = rows.where(~F.coalesce(F.col(tag).isin(list(sinks)), F.lit(False))).select(tag).limit(1).collect()
        if other:
            raise ValueError(f"no sink for tag {other[0][0]!r}")
        for name, (fmt, path) in sinks.items():
            write_once(rows.where(F.col(tag) == name).drop(tag), path, write_id, fmt)
    finally:
        rows.unpersist()


def write_tags_stream(df: DataFrame, sinks: dict[str, tuple[str, str]], checkpoint: str, tag: str = "tag"):
    """Streaming form: the number of a micro-batch is its write id."""
    return df.writeStream.foreachBatch(lambda batch, i: write_tags(batch, sinks, i, tag)).option("checkpointLocation", checkpoint)
