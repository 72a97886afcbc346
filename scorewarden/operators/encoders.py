"""Encoders fitted on one table and applied to any: scaling, frequency, ordinal.

A fitted encoder is a small table, not an object: it can be written, audited,
read back and joined like any other data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewarden.storage import left_lookup

SCALER_SCHEMA = "column string, min double, max double, range double"


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, min, max, range) from one aggregate over all columns.

    An empty column gives 0 and 1, a constant one a range of 1.
    """
    present = [c for c in columns if c in df.columns]
    bounds = df.agg(*(f(F.col(c).cast("double")).alias(f"{tag}{i}")
                      for i, c in enumerate(present) for tag, f in (("lo", F.min), ("hi", F.max))))
    rows = F.array(*(
        F.struct(
            F.lit(c).alias("column"),
            F.coalesce(F.col(f"lo{i}"), F.lit(0.0)).alias("min"),
            F.coalesce(F.col(f"hi{i}"), F.lit(1.0)).alias("max"),
        )
        for i, c in enumerate(present)
    ))
    return bounds.select(F.inline(rows)).withColumn(
        "range", F.when(F.col("max") == F.col("min"), 1.0).otherwise(F.col("max") - F.col("min"))
    )


def apply_minmax(df: DataFrame, fitted: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """(value - min) / range without clipping. The fitted table, one row per column, is a scalar subquery."""
    table = fitted.agg(
        F.map_from_entries(F.collect_list(F.struct("column", F.struct("min", "range")))).alias("t")
    ).scalar()
    return df.withColumns({
        f"{c}{suffix}": (F.col(c) - table[c]["min"]) / table[c]["range"] for c in columns if c in df.columns
    })


def fit_frequency(df: DataFrame, columns: Sequence[str], unseen: str = "zero") -> DataFrame:
    """(column, value, freq, unseen): share of all rows, nulls counted in the total only.

    ``unseen`` is the share given to values that were not fitted: zero, or the
    mean or smallest fitted share of the column.
    """
    present = [c for c in columns if c in df.columns]
    counts = (
        df.select(*(F.col(c).cast("string").alias(c) for c in present))
        .unpivot([], present, "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy("column").agg(
        F.sum("n").alias("total"),
        F.avg(F.when(F.col("value").isNotNull(), F.col("n"))).alias("mean_n"),
        F.min(F.when(F.col("value").isNotNull(), F.col("n"))).alias("min_n"),
    )
    default = {"zero": F.lit(0.0), "mean": F.col("mean_n") / F.col("total"), "min": F.col("min_n") / F.col("total")}
    return (
        counts.where(F.col("value").isNotNull())
        .join(F.broadcast(totals), "column")  # one row per encoded column
        .select("column", "value", (F.col("n") / F.col("total")).alias("freq"), default[unseen].alias("unseen"))
    )


def apply_frequency(df: DataFrame, fitted: DataFrame, columns: Sequence[str], suffix: str = "_頻率") -> DataFrame:
    """Fitted share of each value, the column's default where the value is unknown or null.

    A column without fitted values is skipped.
    """
    defaults = fitted.groupBy("column").agg(F.max("unseen").alias("unseen"))  # one row per encoded column
    known = {r["column"]: r["unseen"] for r in defaults.collect()}
    for c in columns:
        if c not in known or c not in df.columns:
            continue
        table = fitted.where(F.col("column") == c).select(F.col("value").alias(c), F.col("freq").alias("_freq"), F.col("freq").alias("_weight"))
        df = left_lookup(df, table, [c], weight="_weight").withColumn(f"{c}{suffix}", F.coalesce("_freq", F.lit(known[c]))).drop("_freq")
    return df


def ordinal_tables(spark: SparkSession, tables: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """(column, value, ordinal) of fixed code tables."""
    rows = [(c, v, o) for c, table in tables.items() for v, o in table.items()]
    return spark.createDataFrame(rows, "column string, value string, ordinal int")


def fit_summary(df: DataFrame, day: str) -> DataFrame:
    """Rows and date range an encoder was fitted on."""
    return df.agg(
        F.count("*").alias("training_rows"), F.min(day).alias("period_start"), F.max(day).alias("period_end")
    )
