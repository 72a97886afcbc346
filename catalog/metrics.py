"""Ranking, calibration and threshold metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    APPLICATIONS, CUT, DATA_START, MODEL_SCORES, R, SCORED, WINDOWS, applications, metric_ctes, metric_select, model_scores,
    query, scored, tidy, with_,
)
from scorewarden.functions import score_zone
from scorewarden.operators import metrics
from scorewarden.operators.splits import rolling_windows, tag_windows


@query("classification_metrics", with_(SCORED, *metric_ctes("scored", [], "label", "score"), select=metric_select([])))
def classification_metrics(spark, folder):
    return tidy(metrics.classification_metrics(scored(spark, folder), "label", "score"))


@query("metrics_tied_scores", with_(SCORED, *metric_ctes("scored", ["segment"], "late_label", "coarse"), select=metric_select(["segment"])))
def metrics_tied_scores(spark, folder):
    return tidy(metrics.classification_metrics(scored(spark, folder), "late_label", "coarse", ["segment"]))


@query("metrics_by_model", with_(SCORED, MODEL_SCORES, *metric_ctes("model_scores", ["model"], "label", "p"), select=metric_select(["model"])))
def metrics_by_model(spark, folder):
    return tidy(metrics.classification_metrics(model_scores(spark, folder), "label", "p", ["model"]))


@query("metrics_by_month", with_(SCORED, "monthly AS (SELECT *, strftime(day, '%Y-%m') AS month FROM scored)",
       *metric_ctes("monthly", ["month"], "label", "score"), select=metric_select(["month"])))
def metrics_by_month(spark, folder):
    return tidy(metrics.classification_metrics(scored(spark, folder).withColumn("month", F.date_format("day", "yyyy-MM")), "label", "score", ["month"]))


TAGGED_SQL = """tagged AS (SELECT m.*, window_id, CASE WHEN day <= train_end THEN 'train' ELSE 'monitor' END AS phase
  FROM model_scores m JOIN windows ON day BETWEEN train_start AND monitor_end)"""


@query("metrics_by_window", with_(SCORED, MODEL_SCORES, WINDOWS, TAGGED_SQL, *metric_ctes("tagged", ["window_id", "phase", "model"], "label", "p"),
       select=metric_select(["window_id", "phase", "model"])))
def metrics_by_window(spark, folder):
    tagged = tag_windows(scored(spark, folder), rolling_windows(spark, DATA_START, CUT), "day")
    long = model_scores(spark, folder, tagged, ["window_id", "phase"])
    return tidy(metrics.classification_metrics(long, "label", "p", ["window_id", "phase", "model"]))


def _bands(source: str, label: str, score: str) -> str:
    cuts = "cuts AS (SELECT list_sort(list_distinct(quantile_cont({s}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS c FROM {src} WHERE {y} IS NOT NULL)"
    index = " + ".join(f"CASE WHEN len(c) >= {i} AND {score} >= c[{i}] THEN 1 ELSE 0 END" for i in range(1, 10))
    return with_(SCORED, cuts.format(s=score, src=source, y=label),
                 f"banded AS (SELECT {label} AS y, {score} AS p, c, CAST(1 + {index} AS INTEGER) AS decile FROM {source}, cuts WHERE {label} IS NOT NULL)", select=f"""
  SELECT decile, {R("CASE WHEN decile = 1 THEN 0 ELSE MAX(c[decile - 1]) END")} AS score_min, {R("COALESCE(MAX(c[decile]), 1)")} AS score_max,
    COUNT(*) AS count, {R("COUNT(*) / CAST((SELECT COUNT(*) FROM banded) AS DOUBLE)")} AS ratio, {R("AVG(p)")} AS predicted_avg_prob,
    {R("AVG(y)")} AS actual_approve_rate, {R("AVG(p) - AVG(y)")} AS calibration_gap FROM banded GROUP BY decile""")


@query("decile_calibration", _bands("scored", "label", "score"))
def decile_calibration(spark, folder):
    return tidy(metrics.calibration_bands(scored(spark, folder), "label", "score"))


@query("decile_calibration_ties", _bands("scored", "late_label", "discount"))
def decile_calibration_ties(spark, folder):
    return tidy(metrics.calibration_bands(scored(spark, folder), "late_label", "discount"))


@query("routing_confusion", with_(SCORED, select="""SELECT segment, tp AS true_positive, tn AS true_negative, fp AS false_positive, fn AS false_negative,
  ROUND(COALESCE(tn / NULLIF(CAST(tn + fn AS DOUBLE), 0), 0), 4) AS precision_reject_zone, ROUND(COALESCE(tn / NULLIF(CAST(tn + fp AS DOUBLE), 0), 0), 4) AS recall_reject_zone
  FROM (SELECT segment, COUNT(*) FILTER (WHERE label = 1 AND score >= 0.5e0) AS tp, COUNT(*) FILTER (WHERE label = 0 AND score < 0.5e0) AS tn,
    COUNT(*) FILTER (WHERE label = 0 AND score >= 0.5e0) AS fp, COUNT(*) FILTER (WHERE label = 1 AND score < 0.5e0) AS fn FROM scored GROUP BY segment)"""))
def routing_confusion(spark, folder):
    zoned = scored(spark, folder).withColumn("zone", score_zone(F.col("score"), 0.5, 0.85))
    return metrics.routing_confusion(zoned, "label", "zone", ["segment"])


@query("class_balance", with_(APPLICATIONS, select=f"""SELECT segment, COUNT(*) AS n, COUNT(*) FILTER (WHERE label = 1) AS positives,
  COUNT(*) FILTER (WHERE label = 0) AS negatives, {R("AVG(label)")} AS positive_ratio,
  {R("COUNT(*) FILTER (WHERE label = 0) / CAST(COUNT(*) FILTER (WHERE label = 1) AS DOUBLE)")} AS scale_weight,
  {R("COUNT(*) / (2e0 * COUNT(*) FILTER (WHERE label = 1))")} AS weight_positive, {R("COUNT(*) / (2e0 * COUNT(*) FILTER (WHERE label = 0))")} AS weight_negative
  FROM applications WHERE label IS NOT NULL GROUP BY segment"""))
def class_balance(spark, folder):
    return tidy(metrics.class_balance(applications(spark, folder), "label", ["segment"]))


@query("label_coverage", with_(SCORED, select=f"""SELECT segment, COUNT(*) AS total, COUNT(late_label) AS with_label,
  {R("COUNT(late_label) / CAST(COUNT(*) AS DOUBLE)")} AS label_coverage_ratio FROM scored GROUP BY segment"""))
def label_coverage(spark, folder):
    return tidy(metrics.label_coverage(scored(spark, folder), "late_label", ["segment"]))


@query("imbalanced_labels", """WITH docs AS (SELECT quality AS label, n_chars / 200000e0 AS score FROM labels JOIN documents USING (doc_id)),
""" + ",\n".join(metric_ctes("docs", [], "label", "score")) + "\n" + metric_select([]))
def imbalanced_labels(spark, folder):
    from catalog.base import table
    docs = table(spark, folder, "labels").join(table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id")
    return tidy(metrics.classification_metrics(docs.select(F.col("quality").alias("label"), (F.col("n_chars") / 200000.0).alias("score")), "label", "score"))


@query("gini_by_segment", with_(SCORED, *metric_ctes("scored", ["segment"], "label", "score"), select=f"SELECT segment, {R('2 * auc - 1')} AS gini FROM metrics"))
def gini_by_segment(spark, folder):
    rows = metrics.classification_metrics(scored(spark, folder), "label", "score", ["segment"])
    return tidy(rows.select("segment", metrics.gini(F.col("auc")).alias("gini")))
