"""Production monitoring by month and model."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.base import LOWER, MODEL_SCORES, R, SCORED, TODAY, UPPER, metric_ctes, model_scores, query, scored, tidy, with_
from catalog.drift import _INNER, _TERM, _ZONES, _bin
from scorewarden import vocabulary as v
from scorewarden.functions import score_zone
from scorewarden.operators import metrics, monitoring

_CUT, _TRAINED = dt.date(1999, 1, 1), dt.date(2001, 8, 20)


def _monitor_ctes(by: str) -> list[str]:
    zones = ", ".join(f"COUNT(*) FILTER (WHERE {t}) AS c_{z}, COUNT(*) FILTER (WHERE {t}) / CAST(COUNT(*) AS DOUBLE) AS r_{z}" for z, t in _ZONES.items())
    base = ", ".join(f"COUNT(*) FILTER (WHERE {t}) / CAST(COUNT(*) AS DOUBLE) AS b_{z}" for z, t in _ZONES.items())
    return [
        f"late AS (SELECT *, {by} AS period FROM scored WHERE day >= DATE '1999-01-01')",
        f"base AS (SELECT quantile_cont(score, {_INNER}) AS edges, {base} FROM scored WHERE day < DATE '1999-01-01')",
        f"basebins AS (SELECT b AS bin, (SELECT COUNT(*) FROM scored, base WHERE day < DATE '1999-01-01' AND {_bin('score')} = b) / CAST((SELECT COUNT(*) FROM scored WHERE day < DATE '1999-01-01') AS DOUBLE) AS er FROM range(0, 10) t(b))",
        f"""shape AS (SELECT period, COUNT(*) AS total, {zones}, AVG(score) AS mean, STDDEV_POP(score) AS std, quantile_cont(score, 0.5) AS median, MIN(score) AS lo, MAX(score) AS hi,
          quantile_cont(score, 0.25) AS q25, quantile_cont(score, 0.75) AS q75, COUNT(late_label) AS labelled FROM late GROUP BY period)""",
        f"latebins AS (SELECT period, {_bin('score')} AS bin, COUNT(*) AS k FROM late, base GROUP BY 1, 2)",
        "psis AS (SELECT s.period, SUM(" + _TERM.format(a="(COALESCE(k, 0) / CAST(total AS DOUBLE))", e="er") + ") AS psi FROM shape s JOIN basebins e ON TRUE LEFT JOIN latebins l ON l.period = s.period AND l.bin = e.bin GROUP BY 1)",
        *metric_ctes("late", ["period"], "late_label", "score"),
        "joined AS (SELECT s.*, b.* EXCLUDE (edges), psi, m.* EXCLUDE (period) FROM shape s JOIN base b ON TRUE JOIN psis USING (period) LEFT JOIN metrics m ON m.period = s.period)",
    ]


_MONITORED = ", ".join([
    "total", *(f"c_{z} AS zone_{z}_count, {R(f'r_{z}')} AS zone_{z}_ratio, {R(f'b_{z}')} AS baseline_zone_{z}_ratio, {R(f'r_{z} - b_{z}')} AS zone_{z}_shift" for z in _ZONES),
    R("GREATEST(" + ", ".join(f"ABS(r_{z} - b_{z})" for z in _ZONES) + ")") + " AS max_shift",
    *(f"{R(c)} AS score_{n}" for n, c in (("mean", "mean"), ("std", "std"), ("median", "median"), ("min", "lo"), ("max", "hi"), ("q25", "q25"), ("q75", "q75"))),
    "labelled AS with_label", R("labelled / CAST(total AS DOUBLE)") + " AS label_coverage_ratio", R("psi") + " AS score_psi",
    *(f"{R(m)} AS {m}" for m in ("auc", "ks", "f1_reject", "brier_score", "positive_ratio")),
    "CASE WHEN psi >= 0.25e0 THEN 1 ELSE 0 END + CASE WHEN auc < 0.85e0 THEN 1 ELSE 0 END + CASE WHEN f1_reject < 0.30e0 THEN 1 ELSE 0 END AS alerts",
    "psi >= 0.25e0 OR auc < 0.85e0 OR f1_reject < 0.30e0 AS needs_retraining"])
_KEPT = ["total", "max_shift", "with_label", "label_coverage_ratio", "score_psi", "auc", "ks", "f1_reject", "brier_score", "positive_ratio", "alerts", "needs_retraining",
         *(f"score_{c}" for c in ("mean", "std", "median", "min", "max", "q25", "q75")),
         *(f"{p}zone_{z}_{s}" for z in _ZONES for p, s in (("", "count"), ("", "ratio"), ("baseline_", "ratio"), ("", "shift")))]


def _monitored(rows, by):
    early = F.col("day") < F.lit(_CUT)
    result = monitoring.monitor_periods(rows.where(~early), rows.where(early), score="score", label="late_label", lower=LOWER, upper=UPPER, rules=v.MONITORING, by=by)
    return tidy(result.withColumn("alerts", F.size("alerts")).select(*by, *_KEPT))


@query("production_monitoring", with_(SCORED, *_monitor_ctes("0"), select=f"SELECT {_MONITORED} FROM joined"))
def production_monitoring(spark, folder):
    return _monitored(scored(spark, folder), [])


@query("monitoring_by_month", with_(SCORED, *_monitor_ctes("strftime(day, '%Y-%m')"), select=f"SELECT period AS month, {_MONITORED} FROM joined"))
def monitoring_by_month(spark, folder):
    return _monitored(scored(spark, folder).withColumn("month", F.date_format("day", "yyyy-MM")), ["month"])


@query("retrain_trigger", with_(SCORED, MODEL_SCORES, *metric_ctes("model_scores", ["model"], "label", "p"), f"""t AS (SELECT *, CAST(MONTH(DATE '{TODAY}') + 12 * YEAR(DATE '{TODAY}')
    - MONTH(DATE '{_TRAINED}') - 12 * YEAR(DATE '{_TRAINED}') AS INTEGER) AS months FROM metrics)""", select="""SELECT model, auc < 0.85e0 OR f1_reject < 0.30e0 OR months >= 5 AS needs_retraining,
  CONCAT_WS('; ', CASE WHEN auc < 0.85e0 THEN printf('AUC=%.4f < 0.85', auc) END, CASE WHEN f1_reject < 0.30e0 THEN printf('F1_reject=%.4f < 0.3', f1_reject) END,
    CASE WHEN months >= 5 THEN printf('Time: %d months since last training', months) END) AS retraining_trigger_reason FROM t"""))
def retrain_trigger(spark, folder):
    rows = metrics.classification_metrics(model_scores(spark, folder), "label", "p", ["model"]).withColumns(
        {"score_psi": F.lit(None).cast("double"), "trained": F.lit(_TRAINED)})
    rules = {**v.MONITORING, "retrain_months": 5}
    return monitoring.retrain_trigger(rows, rules, trained_on="trained", today=F.lit(TODAY)).select("model", "needs_retraining", "retraining_trigger_reason")


@query("batch_summary", with_(SCORED, select=f"""SELECT segment, COUNT(*) AS total_records, COUNT(*) FILTER (WHERE coarse >= 0.85e0) AS zone_high_count,
  COUNT(*) FILTER (WHERE coarse >= 0.5e0 AND coarse < 0.85e0) AS zone_manual_count, COUNT(*) FILTER (WHERE coarse < 0.5e0) AS zone_low_count,
  {R('AVG(coarse)')} AS score_mean, {R('STDDEV_POP(coarse)')} AS score_std FROM scored GROUP BY segment"""))
def batch_summary(spark, folder):
    zoned = scored(spark, folder).withColumn("zone", score_zone(F.col("coarse"), LOWER, UPPER))
    return tidy(monitoring.batch_summary(zoned, "coarse", "zone", ["segment"]))


# sources: each segment's quartiles as thresholds, by priority; the first has no upper bound and is skipped
@query("resolved_thresholds", with_(SCORED, select=f"""SELECT {R('MIN(coarse)')} AS lower_threshold, {R('MAX(coarse)')} AS upper_threshold, 'N' AS source FROM scored WHERE segment = 'N'"""))
def resolved_thresholds(spark, folder):
    sources = scored(spark, folder).groupBy(F.col("segment").alias("source")).agg(
        F.min("coarse").alias("lower_threshold"), F.max("coarse").alias("upper_threshold")).withColumns({
            "priority": F.when(F.col("source") == "A", 1).when(F.col("source") == "N", 2).otherwise(3),
            "upper_threshold": F.when(F.col("source") != "A", F.col("upper_threshold"))})
    return tidy(monitoring.resolve_thresholds(sources, LOWER, UPPER))
