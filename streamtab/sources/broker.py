"""Message-broker source and the encoded value for a broker sink.

Connecting needs the Kafka connector on the cluster's classpath. Decoding and encoding are plain DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamtab.sources.parse import parse_delimited


def broker_source(
    spark: SparkSession, options: dict[str, str], schema: StructType | str, sep: str = ",", stream: bool = True
) -> DataFrame:
    """Delimited records of one or more topics; starts at the latest offsets unless told otherwise."""
    reader = (spark.readStream if stream else spark.read).format("kafka")
    raw = reader.options(**({"startingOffsets": "latest"} if stream else {}) | options).load()
    return decode(raw, schema, sep)


def decode(raw: DataFrame, schema: StructType | str, sep: str = ",") -> DataFrame:
    """Broker rows (`value` binary) to records."""
    return parse_delimited(raw.select(F.col("value").cast("string").alias("line")), schema, sep)


def to_broker_value(df: DataFrame, columns: list[str], sep: str = ",", key: str | None = None) -> DataFrame:
    """Re-encode rows as one delimited `value` (and an optional `key`)."""
    value = F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]).alias("value")
    return df.select(*([F.col(key).cast("string").alias("key")] if key else []), value)


def write_broker(encoded: DataFrame, options: dict[str, str], checkpoint: str | None = None):
    """Write encoded rows to a topic: a started query for a stream, a finished write for a batch."""
    if encoded.isStreaming:
        return (
            encoded.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()
        )
    return encoded.write.format("kafka").options(**options).save()
