"""Streaming forms of the jobs whose shape differs from the batch form."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamtab.functions.text import is_page_request
from streamtab.functions.times import epoch_us, from_us, micros
from streamtab.operators.eventtime import with_watermark_at
from streamtab.operators.over import top_n
from streamtab.operators.windows import slide
from streamtab.session import scratch_path
from streamtab.sources.sinks import read_latest, upsert_table
from streamtab.streaming.run import drain_batches, start_batches, use_rocksdb


def _item_counts(stream: DataFrame, item: str, size: str, step: str) -> DataFrame:
    return slide(stream, "ts", size, step, [item], {"cnt": ("count", "*")}, "expand")


def _page_counts(stream: DataFrame, size: str, step: str) -> DataFrame:
    return slide(stream.where(is_page_request(F.col("method"), F.col("url"))), "ts", size, step, ["url"], {"cnt": ("count", "*")}, "panes")


def _best(key: str, n: int) -> Callable[[DataFrame], DataFrame]:
    """Ranks the windows of a micro-batch: all counts of a window leave the state in one."""
    return lambda batch: top_n(batch, ["window_end"], [F.col("cnt").desc(), F.col(key)], n)


def start_hot_items(
    stream: DataFrame, item: str, path: str, checkpoint: str, n: int = 5, size: str = "1 hour", step: str = "5 minutes", **trigger
) -> StreamingQuery:
    """Start the top `n` per closed window; see `start_batches` for trigger and restart, `read_batches` for the result."""
    return start_batches(_item_counts(stream, item, size, step), path, checkpoint, "append", _best(item, n), **trigger)


def start_hot_pages(
    stream: DataFrame, path: str, checkpoint: str, n: int = 3, size: str = "10 minutes", step: str = "5 seconds", **trigger
) -> StreamingQuery:
    """Start the top `n` pages per closed window, GET requests of pages only. A page's windows come from a ring of its panes."""
    return start_batches(_page_counts(stream, size, step), path, checkpoint, "append", _best("url", n), **trigger)


def hot_items(stream: DataFrame, item: str, n: int = 5, size: str = "1 hour", step: str = "5 minutes") -> DataFrame:
    """The top `n` per closed window of what is available now."""
    return drain_batches(_item_counts(stream, item, size, step), "hot_items", "append", _best(item, n)).drop("batch")


def hot_pages(stream: DataFrame, n: int, size: str, step: str) -> DataFrame:
    """The top `n` pages per closed window of what is available now."""
    return drain_batches(_page_counts(stream, size, step), "hot_pages", "append", _best("url", n)).drop("batch")


def first_of_day(stream: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """One row per key and day; the state of a day goes when the watermark leaves it."""
    return stream.withColumn("day", F.date_trunc("day", ts)).dropDuplicatesWithinWatermark([*keys, "day"])


def keyed_latest(stream: DataFrame, label: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Upsert sink: last value per key."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    query = (
        stream.writeStream.foreachBatch(lambda batch, i: upsert_table(batch, f"{path}/rows", keys, order, i))
        .option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_latest(spark, f"{path}/rows", keys, order)


def late_flags(
    stream: DataFrame, order: Sequence[str], ts: str, delay: str, marker: Column | None = None
) -> DataFrame:
    """Watermark per row on a stream; the highest time so far is carried from batch to batch in a one-row table."""
    spark = stream.sparkSession
    use_rocksdb(spark)
    path = scratch_path(spark, "late_flags")

    def save(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        marked = with_watermark_at(batch, order, ts, delay, marker)
        own = F.max(epoch_us(ts) if marker is None else F.when(marker, epoch_us(ts))).alias("high")
        high = batch.agg(own)
        if batch_id > 0:
            before = session.read.parquet(f"{path}/high/batch={batch_id - 1}")
            carry = before.first()["high"]
            if carry is not None:
                floor = from_us(F.lit(carry) - micros(delay)).cast(batch.schema[ts].dataType)
                marked = marked.withColumn("watermark", F.greatest("watermark", floor))
                high = before.unionByName(high).agg(F.max("high").alias("high"))
        high.write.mode("overwrite").parquet(f"{path}/high/batch={batch_id}")
        flagged = marked.withColumn("is_late", F.coalesce(F.col(ts) < F.col("watermark"), F.lit(False)))
        flagged.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{path}/rows/batch=*")

