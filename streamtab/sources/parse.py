"""Turn raw lines and JSON values into typed records. Every function works on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamtab.schemas import APP_LOG


def parse_delimited(df: DataFrame, schema: StructType | str, sep: str = ",", line: str = "line") -> DataFrame:
    """Fields by position, cast to `schema`. Blank and short lines are dropped, bad numbers become null."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    parts = F.split(F.trim(F.col(line)), "\\Q" + sep + "\\E")
    split = df.select(parts.alias("_f")).where(F.size("_f") >= len(schema.fields))
    return split.select(
        *[F.trim(F.col("_f")[i]).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    )


def parse_access_log(df: DataFrame, line: str = "line") -> DataFrame:
    """Space-split web log: 0 ip, 1 user, 3 time, 5 method, 6 url."""
    parts = F.split(F.trim(F.col(line)), " ")
    split = df.select(parts.alias("_f")).where(F.size("_f") >= 7)
    return split.select(
        F.col("_f")[0].alias("ip"),
        F.col("_f")[1].alias("user_id"),
        F.try_to_timestamp(F.col("_f")[3], F.lit("dd/MM/yyyy:HH:mm:ss")).alias("ts"),
        F.col("_f")[5].alias("method"),
        F.col("_f")[6].alias("url"),
    )


def parse_app_log(df: DataFrame, value: str = "value") -> DataFrame:
    """Nested application log: the record's structs plus its time as a timestamp."""
    return df.select(F.from_json(value, APP_LOG).alias("_r")).select("_r.*").withColumn(
        "ts", F.timestamp_millis("ts")
    )


def app_log_days(logs: DataFrame) -> DataFrame:
    """The `common` fields with the record's day as yyyyMMdd."""
    return logs.select("common.*", F.date_format("ts", "yyyyMMdd").alias("day"), "ts")


def _image(col: Column, row_ddl: str) -> Column:
    empty = F.from_json(F.lit("{}"), row_ddl)
    return F.coalesce(F.from_json(col, row_ddl), empty)


def parse_change_event(
    df: DataFrame, row_ddl: str, topic: str = "topic", before: str = "before", after: str = "after", op: str = "op"
) -> DataFrame:
    """Change envelope: database and table from the dotted topic, both row images (missing = empty), the operation."""
    parts = F.split(F.col(topic), r"\.")
    keep = [c for c in df.columns if c not in (topic, before, after, op)]
    return df.select(
        F.get(parts, F.lit(1)).alias("db"),
        F.get(parts, F.lit(2)).alias("table_name"),
        _image(F.col(before), row_ddl).alias("before"),
        _image(F.col(after), row_ddl).alias("after"),
        F.lower(F.col(op)).alias("op"),
        *keep,
    )
