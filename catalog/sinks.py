"""Round trips through the writers and readers, in a folder below the one that the session names."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from catalog.base import APPLICATIONS, R, applications, query, tidy, with_
from scorewarden.operators import encoders
from scorewarden.operators.audit import audit_row
from scorewarden.operators.registry import run_record
from scorewarden.plans.challengers import compare_stored
from scorewarden.sources import readers, writers
from scorewarden.storage import use_checkpoint_folder


def _folder(spark) -> str:
    use_checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/round-trip-{uuid.uuid4().hex}"


@query("month_table_round_trip", with_(APPLICATIONS, select="""SELECT dev, strftime(day, '%Y-%m') AS month, COUNT(*) AS n, CAST(SUM(case_id) AS BIGINT) AS ids
  FROM applications WHERE day BETWEEN DATE '1999-11-15' AND DATE '2000-02-10' GROUP BY 1, 2"""))
def month_table_round_trip(spark, folder):
    """Written by part and month, read back between two days across the border of the parts."""
    path = _folder(spark)
    writers.write_by_month(applications(spark, folder).withColumn("month", F.date_format("day", "yyyy-MM")), path, "month", first=["dev"])
    rows = readers.read_between(spark, path, "day", "month", dt.date(1999, 11, 15), dt.date(2000, 2, 10))
    return rows.groupBy(F.col("dev").cast("boolean").alias("dev"), F.col("month").cast("string").alias("month")).agg(F.count("*").alias("n"), F.sum("case_id").alias("ids"))


@query("parts_round_trip", with_(APPLICATIONS, select="SELECT CASE WHEN dev THEN 'development' ELSE 'oot' END AS split, COUNT(*) AS n, COUNT(label) AS labelled FROM applications GROUP BY 1"))
def parts_round_trip(spark, folder):
    path, rows = _folder(spark), applications(spark, folder)
    for name, part in (("development", rows.where("dev")), ("oot", rows.where("not dev").drop("nation"))):
        writers.write_table(part, f"{path}/{name}")
    return readers.read_parts(spark, {n: f"{path}/{n}" for n in ("development", "oot")}).groupBy("split").agg(
        F.count("*").alias("n"), F.count("label").alias("labelled"))


@query("report_round_trip", with_(APPLICATIONS, """counts AS (SELECT segment, COUNT(*) AS n FROM applications GROUP BY 1)""", select="""
  SELECT run_id, part, segment, n FROM counts, (VALUES ('007', 'silver'), ('007', 'gold'), ('8', 'gold')) t(run_id, part)"""))
def report_round_trip(spark, folder):
    """Three parts of two runs, each written twice as by a retry."""
    path, rows = _folder(spark), applications(spark, folder).groupBy("segment").agg(F.count("*").alias("n"))
    for _ in range(2):
        for run, part in (("007", "silver"), ("007", "gold"), ("8", "gold")):
            writers.write_report(rows, f"{path}/report", run, part)
    return writers.read_results(spark, path, "report").select("run_id", "part", "segment", "n")


@query("encoder_round_trip", with_(APPLICATIONS, select=f"""SELECT place, COUNT(*) AS n, {R("COUNT(*) / CAST((SELECT COUNT(*) FROM applications WHERE dev) AS DOUBLE)")} AS freq
  FROM applications WHERE dev AND place IS NOT NULL GROUP BY 1"""))
def encoder_round_trip(spark, folder):
    """A frequency table written with the encoders, as review text, and read back from both."""
    path, rows = _folder(spark), applications(spark, folder).where("dev")
    fitted = encoders.fit_frequency(rows, ["place"])
    writers.write_encoders({"frequency": fitted}, f"{path}/encoders")
    again = writers.read_encoders(spark, f"{path}/encoders", ["frequency"])["frequency"]
    writers.write_frequency_csv(again, f"{path}/review")
    text = readers.read_result_csv(spark, f"{path}/review", "value string, freq double, unseen double").select("value", F.col("freq").alias("_text"))
    applied = encoders.apply_frequency(rows, again, ["place"], "_freq").where("place is not null")
    return tidy(applied.groupBy("place").agg(F.count("*").alias("n"), F.max("place_freq").alias("freq")).join(
        text.withColumnRenamed("value", "place"), "place").where(F.abs(F.col("freq") - F.col("_text")) < 1e-9).drop("_text"))


@query("raw_text_round_trip", with_(APPLICATIONS, select="SELECT COALESCE(band, 'none') AS band, COUNT(*) AS n, CAST(SUM(case_id) AS BIGINT) AS ids FROM applications GROUP BY 1"))
def raw_text_round_trip(spark, folder):
    """Text with a header, read as text only."""
    path = _folder(spark)
    applications(spark, folder).select("case_id", "band").write.option("header", True).csv(path)
    raw = readers.read_raw_csv(spark, path)
    return raw.groupBy(F.coalesce("band", F.lit("none")).alias("band")).agg(F.count("*").alias("n"), F.sum(F.col("case_id").cast("long")).alias("ids"))


@query("audit_round_trip", with_(APPLICATIONS, select="""SELECT '007' AS run_id, COUNT(*) AS rows_before, COUNT(label) AS rows_after, COUNT(*) - COUNT(label) AS rows_dropped,
  COUNT(*) - COUNT(label) AS no_label, 'train' AS mode, '3' AS folds FROM applications"""))
def audit_round_trip(spark, folder):
    """An audit row and a run record, written and read back."""
    path, rows = _folder(spark), applications(spark, folder)
    n, labelled = rows.agg(F.count("*"), F.count("label")).first()
    writers.write_report(audit_row(
        spark, run_id="007", stage="silver", action="clean", input_path="in", output_path="out", rows_before=n, rows_after=labelled,
        drop_reasons={"no_label": n - labelled}), f"{path}/audit", "007")
    writers.write_report(run_record(spark, "007", "train", {"folds": 3}, {"audit": f"{path}/audit"}), f"{path}/runs", "007")
    audit, runs = writers.read_results(spark, path, "audit"), writers.read_results(spark, path, "runs")
    return audit.join(runs, "run_id").select(
        "run_id", "rows_before", "rows_after", "rows_dropped", F.col("drop_reasons")["no_label"].alias("no_label"), "mode", F.col("parameters")["folds"].alias("folds"))


@query("stored_comparison", with_(APPLICATIONS, """figures AS (SELECT dev, AVG(amount) / 1000000 AS auc, AVG(balance) / 10000 AS brier_score FROM applications GROUP BY 1),
long AS (SELECT CASE WHEN dev THEN 'base' ELSE '007' END AS run, 'auc' AS metric, auc AS value FROM figures UNION ALL SELECT CASE WHEN dev THEN 'base' ELSE '007' END, 'brier_score', brier_score FROM figures)""", select=f"""
  SELECT c.run AS run_id, metric, {R("b.value")} AS base_value, {R("c.value")} AS challenger_value, {R("c.value - b.value")} AS delta FROM long c JOIN long b USING (metric) WHERE c.run = '007' AND b.run = 'base'"""))
def stored_comparison(spark, folder):
    """A comparison with the baseline, rebuilt from stored figures."""
    path = _folder(spark)
    figures = applications(spark, folder).groupBy("dev").agg((F.avg("amount") / 1000000).alias("auc"), (F.avg("balance") / 10000).alias("brier_score"))
    writers.write_report(figures.where("not dev").drop("dev"), f"{path}/figures", "007")
    return tidy(compare_stored(spark, path, "figures", figures.where("dev").drop("dev")).select("run_id", "metric", "base_value", "challenger_value", "delta"))
