"""File sources: text lines, delimited tables, literal rows, test tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """One row per text line, column `line`."""
    reader = spark.readStream if stream else spark.read
    return reader.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")


def csv_table(spark: SparkSession, path: str, schema: StructType | str, stream: bool = False, **options: str) -> DataFrame:
    """CSV with a declared schema."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).options(**options).csv(path)


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A table from literal records."""
    return spark.createDataFrame(list(rows), schema)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(
    spark: SparkSession, folder: str, name: str, schema: StructType | str, files_per_trigger: int | None = None
) -> DataFrame:
    """The same parquet table, one file or a folder of files, read as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A pattern that matches just this name: a stream takes a plain path for a folder, a pattern for either.
    return reader.parquet(f"{folder}/{name}.parque[t]")
