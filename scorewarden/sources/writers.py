"""Writing layer tables, result tables and fitted encoders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_counted(df: DataFrame, path: str) -> int:
    """Overwrite a table and return its number of rows, counted while they are written.

    The count is taken in the stage that writes, where Spark counts each finished task once; a task that ran again
    after an executor was lost adds nothing.
    """
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"]


def write_by_month(df: DataFrame, path: str, month: str, first: Sequence[str] = ()) -> None:
    """Overwrite a table with one folder per month, below folders for the ``first`` columns.

    Rows are rebalanced by folder first: adaptive execution then splits a month
    that is too big for one file and merges small ones, so that neither thousands
    of small files nor a single huge one appear, however uneven the months are.
    """
    folders = [f"`{c}`" for c in (*first, month)]
    df.hint("rebalance", *folders).write.mode("overwrite").partitionBy(*first, month).parquet(path)


def write_report(df: DataFrame, path: str, run_id: str, part: str = "all") -> None:
    """The rows of one run, and of one part of it, in a report or history table; a retry replaces them."""
    df.drop("run_id", "part").write.mode("overwrite").parquet(f"{path}/run_id={run_id}/part={part}")


def write_results(tables: Mapping[str, DataFrame], root: str, run_id: str) -> dict[str, str]:
    """One table per result under the root, partitioned by run, so that a rerun replaces only its own rows."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{root}/{name}/run_id={run_id}"
        df.drop("run_id").write.mode("overwrite").parquet(paths[name])
    return paths


def read_results(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A result or report table of all runs, with its run_id as the text it was written with."""
    found = spark.read.parquet(f"{root}/{name}").schema
    # declared, as inference would read the run 007 as the number 7
    declared = StructType([StructField(f.name, StringType()) if f.name in ("run_id", "part") else f for f in found.fields])
    return spark.read.schema(declared).parquet(f"{root}/{name}")


def write_encoders(encoders: Mapping[str, DataFrame], root: str) -> None:
    """Fitted tables such as scaler, frequency, ordinal, features and summary under one folder."""
    for name, df in encoders.items():
        write_table(df, f"{root}/{name}")


def read_encoders(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{root}/{name}") for name in names}


def write_frequency_csv(frequency: DataFrame, root: str) -> None:
    """Frequency table as text for review, one folder per column, most frequent first within a file."""
    (frequency.repartitionByRange("column", F.desc("freq")).sortWithinPartitions("column", F.desc("freq"), "value")
     .write.mode("overwrite").partitionBy("column").option("header", True).csv(root))
