"""Shapes the plans must have whatever the size of the data."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SMALL

QUERIES = entry.queries()


def plan_of(spark, name):
    df = QUERIES[name](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


@pytest.mark.parametrize("name", [
    "zone_summary", "latest_per_key", "classification_metrics", "metrics_by_model", "score_distribution", "psi_numeric", "psi_category",
    "decile_calibration", "threshold_grid", "two_thirds_split", "reject_correlation", "segment_errors", "error_profile_fp", "null_ratios",
    "frequency_fit", "level_statistics", "registry_current", "monitoring_by_month", "registry_ranked", "frequency_encode",
])
def test_only_partial_aggregates_meet_in_one_task(spark, name):
    """One task may see partial aggregates and the table of bucket counts, never rows or distinct values."""
    lines = plan_of(spark, name)
    for here, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in here:
            partial = "partial_" in below or "merge_" in below
            keys = below.split("keys=[")[-1].split("]")[0].split(", ")
            buckets = len(keys) == 2 and keys[1].startswith("_bucket#") or len(keys) == 1 and keys[0].startswith("_part#")  # range partitions
            assert "Aggregate" in below and (partial or buckets), below


def test_scans_read_only_what_is_needed(spark):
    scans = [line for line in plan_of(spark, "zone_summary") if "FileScan" in line]
    assert scans and all("ReadSchema: struct<l_extendedprice:double,l_linestatus:string>" in s for s in scans)


def test_joins_read_only_their_columns(spark):
    scans = [line for line in plan_of(spark, "held_out_rows") if "FileScan" in line]
    assert scans and all("l_comment" not in s and "o_totalprice" not in s for s in scans)


def test_training_days_reach_the_scan(spark, tmp_path):
    from scorewarden.sources.readers import read_table
    rows = spark.read.parquet(f"{SMALL}/orders.parquet").select(F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    rows.write.parquet(f"{tmp_path}/rows")
    part = read_table(spark, f"{tmp_path}/rows").where(F.col("day").between(F.lit(dt.date(1995, 1, 1)), F.lit(dt.date(1995, 4, 30))))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(day,1995-01-01)" in plan and "LessThanOrEqual(day,1995-04-30)" in plan


def test_most_frequent_values_are_limited_before_the_shuffle(spark):
    text = "\n".join(plan_of(spark, "level_statistics"))
    assert text.count("WindowGroupLimit") == 2
