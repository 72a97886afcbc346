"""Reading raw files, layer tables and result tables. Callers own the session."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Header names in file order; reads one line."""
    return spark.read.option("header", True).option("encoding", "UTF-8").csv(path).columns


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All columns as text, with the time of loading. Nothing is inferred from the data."""
    names = columns or csv_columns(spark, path)
    schema = StructType([StructField(c, StringType()) for c in names])
    raw = spark.read.option("header", True).option("encoding", "UTF-8").schema(schema).csv(path)
    return raw.withColumn("bronze_load_timestamp", F.current_timestamp())


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; folders such as month=2024-04 become a column."""
    return spark.read.parquet(path)


def read_result_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def read_between(
    spark: SparkSession, path: str, day: str, month: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Rows of a month-partitioned table between two dates.

    The dates alone would read every file, since the folders are months; the
    added month bounds prune them.
    """
    df = read_table(spark, path)
    if start:
        df = df.where((F.col(day) >= F.lit(start)) & (F.col(month).cast("string") >= start.strftime("%Y-%m")))
    if end:
        df = df.where((F.col(day) <= F.lit(end)) & (F.col(month).cast("string") <= end.strftime("%Y-%m")))
    return df


def read_parts(spark: SparkSession, parts: dict[str, str], split: str = "split") -> DataFrame:
    """Union of tables, each row tagged with the name of its part."""
    tables = [read_table(spark, path).withColumn(split, F.lit(name)) for name, path in parts.items()]
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table, allowMissingColumns=True)
    return whole
