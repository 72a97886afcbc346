"""Jobs with their sinks: stored counts, monitoring that leads to a retraining, and tables read back as they were written."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.base import (
    APPLICATIONS, CUT, DATA_START, LOWER, RAW, RAW_COLUMNS, TODAY, UPPER, WINDOWS, applications, day_text, query, raw_applications, with_,
)
from catalog.models import _setup, _table
from catalog.sinks import _folder
from scorewarden import vocabulary as v
from scorewarden.operators import encoders, features, splits
from scorewarden.plans import layers, training, watch
from scorewarden.sources import readers, writers


@query("bronze_rows", with_(RAW, select="SELECT COUNT(*) AS rows FROM raw"))
def bronze_rows(spark, folder):
    """The raw text as a job loads it, and the number of rows it reports."""
    path = _folder(spark)
    raw_applications(spark, folder).write.option("header", True).csv(f"{path}/raw")
    return spark.createDataFrame([(layers.run_bronze(spark, f"{path}/raw", f"{path}/bronze"),)], "rows long")


@query("leak_dropped", with_(RAW, select=f"""SELECT COUNT(*) AS rows, CAST(COUNT("{v.CASE}") AS BIGINT) AS cases, FALSE AS leaks FROM raw"""))
def leak_dropped(spark, folder):
    """A column that gives the outcome away does not survive cleaning."""
    cleaned = layers.cleaned_table(raw_applications(spark, folder).withColumn(v.LEAK, F.lit("x")))
    return cleaned.agg(F.count("*").alias("rows"), F.count(v.CASE).alias("cases"), F.lit(v.LEAK in cleaned.columns).alias("leaks"))


_PRUNED = ["車齡"]
_LEFT = [c for c in RAW_COLUMNS if c not in v.NON_FEATURES and c not in _PRUNED]


@query("model_column_counts", with_(RAW, select=" UNION ALL ".join(f"""SELECT '{c}' AS feature, COUNT("{c}") AS n FROM raw""" for c in _LEFT)))
def model_column_counts(spark, folder):
    """Columns left for a model, each with its known values."""
    raw = raw_applications(spark, folder)
    names = features.model_columns(raw, v.NON_FEATURES, _PRUNED)
    return raw.select(F.inline(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).isNotNull().cast("long").alias("known")) for c in names)))).groupBy(
        "feature").agg(F.sum("known").alias("n"))


_LEVELS = ", ".join(f"('{level}', {code})" for level, code in v.EDUCATION.items())


@query("ordinal_levels", with_(RAW, select=f"""SELECT value, CAST(ordinal AS INTEGER) AS ordinal, COUNT(*) AS n
  FROM raw JOIN (VALUES {_LEVELS}) t(value, ordinal) ON "教育程度" = value GROUP BY 1, 2"""))
def ordinal_levels(spark, folder):
    """Rows per level of a stored code table."""
    table = encoders.ordinal_tables(spark, {"教育程度": v.EDUCATION, "月所得": v.INCOME_BANDS}).where("column = '教育程度'")
    return raw_applications(spark, folder).join(F.broadcast(table), F.col("教育程度") == F.col("value")).groupBy("value", "ordinal").agg(F.count("*").alias("n"))


@query("stored_windows", with_(APPLICATIONS, WINDOWS, select="""SELECT window_id, CAST(train_start AS VARCHAR) AS train_start, CAST(train_end AS VARCHAR) AS train_end,
  CAST(monitor_start AS VARCHAR) AS monitor_start, CAST(monitor_end AS VARCHAR) AS monitor_end, COUNT(day) AS rows
  FROM windows LEFT JOIN applications ON day BETWEEN train_start AND monitor_end GROUP BY ALL"""))
def stored_windows(spark, folder):
    """Window definitions stored as text, typed when read, with the rows they cover."""
    windows = splits.rolling_windows(spark, DATA_START, CUT)
    stored = windows.select(*(F.col(c).cast("string").alias(c) for c in windows.columns))
    typed = splits.typed_windows(stored)
    rows = splits.tag_windows(applications(spark, folder), typed, "day").groupBy("window_id").agg(F.count("*").alias("rows"))
    days = ["train_start", "train_end", "monitor_start", "monitor_end"]
    return day_text(typed.join(rows, "window_id", "left").na.fill(0, ["rows"]), *days).select("window_id", *days, "rows")


@query("results_round_trip", with_(APPLICATIONS, select="""SELECT name, run_id, COUNT(*) AS n FROM applications,
  (VALUES ('segments', '007'), ('segments', '8'), ('nations', '007'), ('nations', '8')) t(name, run_id) WHERE name = 'segments' OR nation IS NOT NULL GROUP BY 1, 2"""))
def results_round_trip(spark, folder):
    """The result tables of two runs under one root, each written twice as by a retry."""
    path, rows = _folder(spark), applications(spark, folder)
    tables = {"segments": rows.groupBy("segment").agg(F.count("*").alias("n")), "nations": rows.where("nation is not null").groupBy("nation").agg(F.count("*").alias("n"))}
    for run in ("007", "8", "007"):
        writers.write_results(tables, path, run)
    parts = [writers.read_results(spark, path, name).groupBy(F.lit(name).alias("name"), "run_id").agg(F.sum("n").alias("n")) for name in tables]
    return parts[0].unionByName(parts[1])


def _monitored(spark, folder, path):
    """Out-of-time rows, scored by their amount, monitored by a job whose model is long out of date."""
    rows = applications(spark, folder).withColumn("score", F.least(F.col("amount") / 500000, F.lit(1.0)))
    return watch.run_monitoring(
        rows.where("not dev"), rows.where("dev"), path, label="label", score="score", trained_on=dt.date(2001, 1, 1), today=TODAY)


_PERIODS = f"""periods AS (SELECT CAST(DATE '{TODAY}' - INTERVAL 24 MONTH AS DATE) AS a, CAST(DATE '{TODAY}' - INTERVAL 6 MONTH AS DATE) AS b, DATE '{TODAY}' AS c)"""


@query("monitoring_sinks", with_(APPLICATIONS, _PERIODS, select=f"""SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE LEAST(amount / 500000e0, 1e0) >= {UPPER}) AS high,
  COUNT(*) FILTER (WHERE LEAST(amount / 500000e0, 1e0) < {LOWER}) AS low, '{TODAY}' AS decided_on, CAST(ANY_VALUE(a) AS VARCHAR) AS development_start,
  CAST(ANY_VALUE(b) AS VARCHAR) AS policy_validation_start, '{TODAY}' AS final_holdout_end FROM applications, periods WHERE NOT dev"""))
def monitoring_sinks(spark, folder):
    """What the monitoring job has stored: its row, and the decision to retrain with its periods."""
    path = _folder(spark)
    _monitored(spark, folder, path)
    row = writers.read_results(spark, path, "monitoring_results")
    decision = writers.read_results(spark, path, "retraining_decisions").select(
        "run_id", F.col("decided_on").cast("string").alias("decided_on"), "development_start", "policy_validation_start", "final_holdout_end")
    return row.join(decision, "run_id").select(
        F.col("total").alias("total_records"), F.col("zone_high_count").alias("high"), F.col("zone_low_count").alias("low"), "decided_on", "development_start", "policy_validation_start", "final_holdout_end")


@query("retrained_version", with_(APPLICATIONS, _PERIODS, "rows AS (SELECT day, label, a, b FROM applications, periods WHERE day BETWEEN a AND c AND label IS NOT NULL)", select="""
  SELECT 'baseline_v4' AS baseline_name, CAST(ANY_VALUE(a) AS VARCHAR) AS period_start, COUNT(*) FILTER (WHERE day < b) AS train_rows,
    (2 * COUNT(*) FILTER (WHERE day >= b)) // 3 AS policy_rows, COUNT(*) FILTER (WHERE day >= b) - (2 * COUNT(*) FILTER (WHERE day >= b)) // 3 AS holdout_rows, TRUE AS stored FROM rows"""))
def retrained_version(spark, folder):
    """From the monitoring row to the registered version: the stored decision is read and its periods are trained on."""
    path = _folder(spark)
    _monitored(spark, folder, path)
    decisions = writers.read_results(spark, path, "retraining_decisions")
    versions = spark.createDataFrame([("baseline_v1",), ("baseline_v3",)], "baseline_name string")
    row = training.retrain_on_decision(decisions, _table(spark, folder), _setup(), f"{path}/training", "r1", versions, method="sigmoid")
    stored = readers.read_table(spark, f"{path}/training/registry").agg(F.max("model_name")).scalar() == F.col("model_name")
    return row.select("baseline_name", "period_start", "train_rows", "policy_rows", "holdout_rows", stored.alias("stored"))
