"""Start a streaming frame with a sink, trigger and checkpoint of the caller's, or run it over everything available now and read it back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamtab.session import scratch_path
from streamtab.sources.sinks import last_per_key

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep state on local disk with changelog checkpoints; needed by transformWithState."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)


def start_rows(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", **trigger) -> StreamingQuery:
    """Start writing every emitted row to `path`. Without a trigger (`processingTime=...`, `availableNow=True`) batches follow each other at once.

    Started again with its checkpoint, the query goes on where it was stopped, and rows are neither lost nor repeated.
    """
    use_rocksdb(stream.sparkSession)
    writer = stream.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start(path)


def start_batches(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "update", each: Callable[[DataFrame], DataFrame] | None = None, **trigger
) -> StreamingQuery:
    """Start writing what `each` makes of every micro-batch. A batch owns its folder, so one that runs again after a failure overwrites and does
    not repeat. Trigger and restart as in `start_rows`; `read_batches` reads the result at any time."""
    use_rocksdb(stream.sparkSession)

    def save(batch: DataFrame, batch_id: int) -> None:
        out = each(batch) if each else batch
        out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = stream.writeStream.outputMode(mode).foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """What `start_batches` has written, with its `batch` number."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    return rows.withColumn("batch", F.col("batch").cast("bigint"))


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Append mode: every emitted row of what is available now."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    start_rows(stream, f"{path}/rows", f"{path}/state", availableNow=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def drain_batches(
    stream: DataFrame, label: str, mode: str = "update", each: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Every emission with its `batch` number, of what is available now."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    start_batches(stream, f"{path}/rows", f"{path}/state", mode, each, availableNow=True).awaitTermination()
    return read_batches(spark, f"{path}/rows")


def drain_latest(stream: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """Update mode: the last value of every key."""
    return last_per_key(drain_batches(stream, label), keys, ["batch"]).drop("batch")
