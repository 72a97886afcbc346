"""Selection, upgrade, registry and monitoring rules on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scorewarden import vocabulary as v
from scorewarden.operators import diagnosis, monitoring, registry, selection, splits
from scorewarden.plans import challengers

GOOD = {"auc": 0.90, "f1_reject": 0.40, "low_zone_reject_precision": 0.53, "high_zone_approve_precision": 0.985,
        "manual_review_ratio": 0.09, "low_zone_ratio": 0.03}
REST = {m: 0.5 for m in challengers.METRIC_COLUMNS if m not in GOOD}


def table(spark, *rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(
        f"{k} {'string' if isinstance(x, str) else 'boolean' if isinstance(x, bool) else 'double'}" for k, x in rows[0].items()))


def decide(spark, **changes):
    penalty = changes.pop("overfitting_penalty", 0.0)
    better = {**GOOD, "low_zone_reject_precision": 0.60, **REST, **changes}
    rows = table(spark, {"challenger": "c", **better, "overfitting_penalty": penalty})
    return challengers.upgrade_rows(rows, table(spark, {**GOOD, **REST})).first()


@pytest.mark.parametrize("changes,status", [
    ({}, "full_upgrade"),
    ({"high_zone_approve_precision": 0.97}, "reject"),
    ({"low_zone_reject_precision": 0.534}, "reject"),
    ({"manual_review_ratio": 0.12}, "reject"),
    ({"auc": 0.88}, "routing_only_upgrade"),
    ({"f1_reject": 0.37}, "routing_only_upgrade"),
    ({"overfitting_penalty": 0.03}, "routing_only_upgrade"),
])
def test_upgrade_ladder(spark, changes, status):
    assert decide(spark, **changes)["upgrade_candidate"] == status


def test_reject_reason_names_the_workload_when_that_is_the_cause(spark):
    reason = decide(spark, manual_review_ratio=0.2)["upgrade_reason"]
    assert "workload" in reason and "precision" not in reason


def test_a_full_upgrade_is_reachable_from_predictions(spark):
    """Both sides carry every metric the ladder asks for, so nothing defaults to failure."""
    rng = [(1, 0.95)] * 980 + [(0, 0.95)] * 5 + [(0, 0.2)] * 15
    worse = [(1, 0.95)] * 970 + [(1, 0.2)] * 10 + [(0, 0.95)] * 8 + [(0, 0.2)] * 12
    zone = F.when(F.col("pred_prob") < 0.5, 0).when(F.col("pred_prob") >= 0.85, 2).otherwise(1)
    figures = lambda rows, n: challengers.holdout_figures(
        spark.createDataFrame(rows, "actual_label int, pred_prob double").withColumn("pred_zone", zone), n)
    row = challengers.upgrade_rows(
        figures(rng, "better").withColumn("overfitting_penalty", F.lit(0.0)), figures(worse, "base")).first()
    assert row["upgrade_candidate"] == "full_upgrade"


def test_final_decision_uses_the_challengers_own_thresholds(spark):
    base = table(spark, {"name": "baseline_v1", "lower_threshold": 0.5, "upper_threshold": 0.85})
    decisions = table(
        spark, {"challenger": "C2", "upgrade_candidate": "reject", "upgrade_reason": "r", "lower_threshold": 0.4, "upper_threshold": 0.7},
        {"challenger": "C3", "upgrade_candidate": "routing_only_upgrade", "upgrade_reason": "s", "lower_threshold": 0.6, "upper_threshold": 0.9})
    row = challengers.final_decision(decisions, base).first()
    assert (row["chosen"], row["decision_type"], row["lower_threshold"]) == ("C3", "ROUTING_ONLY_UPGRADE", 0.6)
    kept = challengers.final_decision(decisions.where("challenger = 'C2'"), base).first()
    assert (kept["chosen"], kept["decision_type"], kept["upper_threshold"]) == ("baseline_v1", "RETAIN_BASELINE", 0.85)


def test_overfitting_grades(spark):
    rows = [{"id": str(g), "train_auc": 0.9, "avg_monitor_auc": 0.9 - g, "final_holdout_auc": 0.9, "train_brier": 0.1,
             "avg_monitor_brier": 0.21, "final_holdout_f1_reject": 0.44} for g in (0.01, 0.03, 0.07, 0.2)]
    got = selection.stage_gaps(table(spark, *rows)).orderBy("id").collect()
    assert [r["overfitting_severity"] for r in got] == ["none", "mild", "moderate", "severe"]
    assert all(r["has_calibration_issue"] and r["has_reject_detection_issue"] for r in got)


def test_retrain_trigger_counts_calendar_months_and_ignores_nulls(spark):
    rows = spark.createDataFrame(
        [(None, None, None, dt.date(2024, 1, 31)), (0.5, 0.5, 0.1, dt.date(2024, 5, 1)), (0.9, 0.5, 0.25, dt.date(2024, 6, 30))],
        "auc double, f1_reject double, score_psi double, trained date")
    got = monitoring.retrain_trigger(rows, v.MONITORING, trained_on="trained", today=F.lit(dt.date(2024, 7, 1))).collect()
    assert [r["retraining_trigger_reason"] for r in got] == [
        "Time: 6 months since last training", "AUC=0.5000 < 0.85", "Score PSI=0.2500 >= 0.25"]
    assert all(r["needs_retraining"] for r in got)


def test_zero_is_a_threshold(spark):
    rows = table(spark, {"source": "cli", "priority": 1.0, "lower_threshold": 0.0, "upper_threshold": 0.9})
    assert monitoring.resolve_thresholds(rows, 0.5, 0.85).first()["lower_threshold"] == 0.0
    assert monitoring.resolve_thresholds(rows.limit(0), 0.5, 0.85).first()["source"] == "default"


def test_retraining_periods_clamp_at_month_end(spark):
    day = spark.createDataFrame([(dt.date(2024, 8, 31),)], "d date")
    row = splits.retraining_periods(day, "d").first()
    assert (row["data_start"], row["development_end"], row["policy_validation_start"]) == ("2022-08-31", "2024-02-28", "2024-02-29")
    assert (row["policy_validation_end"], row["final_holdout_start"]) == ("2024-06-28", "2024-06-29")


def test_registry_keeps_the_first_of_equal_models(spark):
    rows = spark.createDataFrame([("v1", 0.9, 2), ("v2", 0.9, 1), ("v3", None, 3)], "model_version string, auc_test double, place int")
    assert registry.best_version(rows, "auc_test", order="place").first()["best_version"] == "v2"
    marked = registry.auto_select_best(rows, "auc_test", order="place").where("is_best").collect()
    assert [r["model_version"] for r in marked] == ["v2"]
    assert registry.next_version(spark.createDataFrame([("baseline_v2",), ("other",)], "n string"), "n").first()["next_name"] == "baseline_v3"
    assert registry.next_version(spark.createDataFrame([], "n string"), "n").first()["next_name"] == "baseline_v1"


def test_false_positives_are_counted_not_rows(spark):
    df = spark.createDataFrame([(0, 0.9), (1, 0.9), (1, 0.1), (0, 0.6)], "y int, p double").withColumns({"lo": F.lit(0.5), "hi": F.lit(0.85)})
    got = diagnosis.error_flags(df, "y", "p", "lo", "hi").agg(F.sum("is_FP"), F.sum("is_FN"), F.sum("is_correct")).first()
    assert tuple(got) == (1, 1, 1)


def test_score_of_a_single_class_period_has_no_auc(spark):
    rows = [("a", 0.1 * i, 1) for i in range(10)] + [("b", 0.1 * i, i % 2) for i in range(10)]
    df = spark.createDataFrame(rows, "m string, p double, y int")
    got = {r["m"]: r for r in monitoring.monitor_periods(
        df, df, score="p", label="y", lower=0.0, upper=0.85, rules=v.MONITORING, by=["m"]).collect()}
    assert got["a"]["auc"] is None and got["b"]["auc"] is not None
    assert got["a"]["zone_low_count"] == 0 and got["a"]["score_psi"] == pytest.approx(0)
