"""Rolling results to champion, candidate scores, gap diagnostics and upgrade decisions.

Inputs here are result tables, with one row per window, model or candidate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scorewarden.functions import flag, joined_reasons, verdict


def rank_champions(cycles: DataFrame, weights: Mapping[str, float], spread: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per model: means and population deviations over cycles, stability, score and rank.

    ``spread`` names the metrics whose deviations are averaged into the stability
    score; ``weights`` names the means that make up the overall score, with
    ``stability`` as a deduction.
    """
    metrics = {
        "cv_auc": "cv_auc_mean", "cv_f1_reject": "cv_f1_reject_mean", "monitor_auc": "monitor_auc",
        "monitor_f1": "monitor_f1", "monitor_f1_reject": "monitor_f1_reject", "monitor_ks": "monitor_ks",
        "monitor_brier": "monitor_brier",
    }
    stats = cycles.groupBy(*by, "model_name").agg(
        F.count("*").alias("cycles"),
        *(F.avg(c).alias(f"avg_{m}") for m, c in metrics.items()),
        *(F.stddev_pop(c).alias(f"std_{m}") for m, c in metrics.items()))
    parts = [m for m in weights if m != "stability" and weights[m]]
    score = sum((F.col(f"avg_{m}") * weights[m] for m in parts), F.lit(0.0))
    reason = F.concat_ws(" + ", *(F.format_string(f"{m}=%.4f*{weights[m]}", F.col(f"avg_{m}")) for m in parts))
    return (
        stats.withColumn("stability_score", sum((F.col(f"std_{m}") for m in spread), F.lit(0.0)) / len(spread))
        .withColumn("overall_score", score - F.col("stability_score") * weights["stability"])
        .withColumn("ranking_reason", F.concat(reason, F.format_string(
            f" - stability=%.4f*{weights['stability']}", F.col("stability_score"))))
        .withColumn("model_rank", F.row_number().over(  # one row per model
            W.partitionBy(*by).orderBy(F.desc("overall_score"), "model_name")))
    )


def rolling_stability(cycles: DataFrame, preferred: str = "boosted") -> DataFrame:
    """Mean results of the preferred model, else of the first by name; sample deviation as stability."""
    chosen = cycles.agg(F.coalesce(
        F.min(F.when(F.lower("model_name").contains(preferred), F.col("model_name"))), F.min("model_name"))).scalar()
    return cycles.where(F.col("model_name") == chosen).groupBy("model_name").agg(
        *(F.avg(c).alias(f"avg_{c}") for c in ("monitor_auc", "monitor_f1_reject", "monitor_ks", "monitor_brier")),
        F.stddev("monitor_auc").alias("std_monitor_auc"), F.stddev("monitor_auc").alias("stability_score"))


def stage_gaps(df: DataFrame) -> DataFrame:
    """Gaps between train, monitor and holdout, the overfitting grade, and two quality flags."""
    train_monitor = F.col("train_auc") - F.col("avg_monitor_auc")
    train_holdout = F.col("train_auc") - F.col("final_holdout_auc")
    worst = F.greatest(F.abs(train_monitor), F.abs(train_holdout))
    both = (F.col("train_brier") > 0) & (F.col("avg_monitor_brier") > 0)
    f1r = F.col("final_holdout_f1_reject")
    return df.withColumns({
        "gap_train_vs_monitor_auc": train_monitor,
        "gap_train_vs_holdout_auc": train_holdout,
        "gap_monitor_vs_holdout_auc": F.col("avg_monitor_auc") - F.col("final_holdout_auc"),
        "gap_train_vs_monitor_brier": F.when(both, F.col("avg_monitor_brier") - F.col("train_brier")).otherwise(0.0),
        "is_overfitting": worst >= 0.02,
        "overfitting_severity": F.when(worst < 0.02, "none").when(worst < 0.05, "mild").when(
            worst < 0.10, "moderate").otherwise("severe"),
        "has_calibration_issue": both & (F.col("avg_monitor_brier") > 2 * F.col("train_brier")),
        "has_reject_detection_issue": (f1r > 0) & (f1r < 0.45),
    })


def tuning_score(df: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Weighted mean of holdout and monitor results; Brier scores count as 1 - value, stability is deducted."""
    def part(name: str, weight: float) -> Column:
        value = F.col(name)
        if name == "stability_score":
            return -weight * value
        return weight * ((1 - value) if name.endswith("brier") else value)
    score = sum((part(n, w) for n, w in weights.items()), F.lit(0.0))
    return df.withColumn("tuning_score", score).withColumn("tuning_rank", F.row_number().over(  # one row per candidate
        W.orderBy(F.desc("tuning_score"), "config_id", "calibration_method")))


def decision_score(df: DataFrame, c: Mapping[str, float]) -> DataFrame:
    """Decision score, penalties, hard limits and rank of candidates, limit-abiding ones first."""
    over = lambda value, limit: F.greatest(value - limit, F.lit(0.0))
    gaps = df.withColumns({
        "train_monitor_auc_gap": F.col("avg_train_auc") - F.col("avg_monitor_auc"),
        "monitor_holdout_auc_gap": F.col("avg_monitor_auc") - F.col("holdout_auc"),
        "calibration_gap": F.col("avg_monitor_brier") - F.col("train_brier"),
        "f1r_gap": F.col("avg_monitor_f1_reject") - F.col("holdout_f1_reject"),
    })
    high, low = F.col("high_zone_approve_precision"), F.col("low_zone_reject_precision")
    manual, auto, gap = F.col("manual_review_ratio"), F.col("auto_decision_rate"), F.col("train_monitor_auc_gap")
    score = (
        c["w_low_zone_reject_precision"] * low + c["w_high_zone_approve_precision"] * high
        + c["w_manual_review"] * (1 - manual) + c["w_holdout_f1_reject"] * F.col("holdout_f1_reject")
        + c["w_holdout_brier"] * (1 - F.col("holdout_brier")) + c["w_holdout_auc"] * F.col("holdout_auc")
        + c["w_holdout_ks"] * F.col("holdout_ks"))
    limits = [
        (high < c["min_high_zone_approve_precision"], "high_zone_approve_precision", high),
        (manual > c["max_manual_review_ratio"], "manual_review_ratio", manual),
        (auto < c["min_auto_decision_rate"], "auto_decision_rate", auto),
        (gap > c["hard_train_monitor_auc_gap"], "train_monitor_auc_gap", gap),
    ]
    return (
        gaps.withColumns({
            "decision_score": score,
            "overfitting_penalty": c["overfitting_weight"] * (
                over(gap, c["max_train_monitor_auc_gap"])
                + over(F.abs("monitor_holdout_auc_gap"), c["max_monitor_holdout_auc_gap"])
                + over(F.col("stability_score"), c["max_stability_score"])),
            "robustness_penalty": c["robustness_weight"] * (
                over(F.col("f1r_gap"), c["max_f1r_gap"]) + over(F.col("calibration_gap"), c["max_calibration_gap"])),
            "constraint_violations": joined_reasons(
                *((test, F.format_string(f"{name}=%.4f", value)) for test, name, value in limits)),
            "meets_low_zone_target": low >= c["target_low_zone_reject_precision"],
        })
        .withColumn("passes_hard_constraints", F.col("constraint_violations") == "")
        .withColumn("final_selection_score",
                    F.col("decision_score") - F.col("overfitting_penalty") - F.col("robustness_penalty"))
        .withColumn("selection_rank", F.row_number().over(W.orderBy(  # one row per candidate
            F.desc("passes_hard_constraints"), F.desc("final_selection_score"), "config_id")))
    )


def upgrade_decision(df: DataFrame, rules: Mapping[str, float]) -> DataFrame:
    """Routing must improve and the high zone stay pure; classifier guardrails separate full from routing-only.

    Expects ``base_*`` and ``ch_*`` columns of the same split for auc, f1_reject,
    low_zone_reject_precision, high_zone_approve_precision, manual_review_ratio
    and low_zone_ratio, and ``overfitting_penalty``.
    """
    base_work = F.col("base_manual_review_ratio") + F.col("base_low_zone_ratio")
    work = F.col("ch_manual_review_ratio") + F.col("ch_low_zone_ratio")
    tests = {
        "precision_improved": F.col("ch_low_zone_reject_precision")
        > F.col("base_low_zone_reject_precision") + rules["precision_gain"],
        "workload_ok": work <= base_work + rules["workload_slack"],
        "high_zone_ok": F.col("ch_high_zone_approve_precision") >= rules["min_high_precision"],
        "auc_ok": F.col("ch_auc") >= F.col("base_auc") - rules["auc_slack"],
        "f1_reject_ok": F.col("ch_f1_reject") >= F.col("base_f1_reject") - rules["f1_reject_slack"],
        "overfit_ok": F.col("overfitting_penalty") < rules["max_overfitting"],
    }
    t = {name: F.col(name) for name in tests}
    routing = t["precision_improved"] & t["workload_ok"] & t["high_zone_ok"]
    classifier = t["auc_ok"] & t["f1_reject_ok"] & t["overfit_ok"]
    reason = joined_reasons(
        (~t["high_zone_ok"], F.lit("high zone precision below the floor")),
        (~t["precision_improved"], F.lit("low zone precision did not improve")),
        (~t["workload_ok"], F.lit("review workload grew")),
        (~t["auc_ok"], F.lit("AUC regressed")),
        (~t["f1_reject_ok"], F.lit("F1 of rejects regressed")),
        (~t["overfit_ok"], F.lit("overfitting penalty too high")))
    return df.withColumns({"base_workload": base_work, "ch_workload": work, **tests}).withColumns({
        "upgrade_candidate": F.when(~routing, "reject").when(classifier, "full_upgrade").otherwise("routing_only_upgrade"),
        "upgrade_reason": F.when(reason == "", "all checks hold").otherwise(reason),
        "suitable_for_routing": routing,
        "suitable_for_replacement": routing & classifier,
    })


def long_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """(ids, metric, value)."""
    return df.select(*ids, *(F.col(m).cast("double").alias(m) for m in metrics)).unpivot(
        list(ids), list(metrics), "metric", "value")


def compare_metrics(
    base: DataFrame, challenger: DataFrame, lower_is_better: Sequence[str], on: Sequence[str] = (), tolerance: float = 0.001
) -> DataFrame:
    """Join long metric tables on the metric: values, delta and verdict; a metric missing on a side is left out."""
    keys = [*on, "metric"]
    return (
        base.withColumnRenamed("value", "base_value")
        .join(challenger.withColumnRenamed("value", "challenger_value"), keys)
        .where(F.col("base_value").isNotNull() & F.col("challenger_value").isNotNull())
        .withColumn("delta", F.col("challenger_value") - F.col("base_value"))
        .withColumn("verdict", verdict(F.col("delta"), ~F.col("metric").isin(*lower_is_better), tolerance))
    )


def compare_baselines(base: DataFrame, other: DataFrame, lower_is_better: Sequence[str] = ("brier_score",)) -> DataFrame:
    """Delta to 6 places and whether the other one is better at all."""
    better = F.when(F.col("metric").isin(*lower_is_better), F.col("delta") < 0).otherwise(F.col("delta") > 0)
    return compare_metrics(base, other, lower_is_better).select(
        "metric", "base_value", "challenger_value", F.round("delta", 6).alias("delta"), better.alias("improved"))


UPGRADE_RANK = {"full_upgrade": 3, "routing_only_upgrade": 2, "reject": 1}


def best_challenger(df: DataFrame, name: str = "challenger", status: str = "upgrade_candidate", by: Sequence[str] = ()) -> DataFrame:
    """The challenger with the highest status, first by name on ties; none when all were rejected or failed."""
    rank = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for p in UPGRADE_RANK.items() for x in p)), F.col(status)), F.lit(0))
    top = df.withColumn("_rank", rank).withColumn("_order", F.row_number().over(  # one row per challenger
        W.partitionBy(*by).orderBy(F.desc("_rank"), name))).where("_order = 1")
    promoted = F.col("_rank") > 1
    return top.select(
        *by,
        F.when(promoted, F.col(name)).alias("best_challenger"),
        F.when(promoted, F.col(status)).otherwise("reject").alias("best_status"),
        F.when(F.col(status) == "full_upgrade", "FULL_UPGRADE").when(
            F.col(status) == "routing_only_upgrade", "ROUTING_ONLY_UPGRADE").otherwise("RETAIN_BASELINE").alias("decision_type"))


def resolve_decision(best: DataFrame, baseline: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: the model to run, with its own thresholds, and why.

    ``baseline``: one row (name, lower_threshold, upper_threshold). ``candidates``:
    (challenger, lower_threshold, upper_threshold, upgrade_reason).
    """
    base = baseline.select(F.struct("name", "lower_threshold", "upper_threshold").alias("b")).scalar()
    joined = best.join(candidates, best["best_challenger"] == candidates["challenger"], "left")
    return joined.select(
        base["name"].alias("active_baseline"), "decision_type",
        F.coalesce("best_challenger", base["name"]).alias("chosen"),
        F.coalesce("lower_threshold", base["lower_threshold"]).alias("lower_threshold"),
        F.coalesce("upper_threshold", base["upper_threshold"]).alias("upper_threshold"),
        F.coalesce("upgrade_reason", F.lit("no challenger met the promotion criteria")).alias("decision_reason"))


def recommendation(df: DataFrame) -> DataFrame:
    """What the routing figures allow each zone to be used for."""
    high, low = F.col("high_zone_approve_precision"), F.col("low_zone_reject_precision")
    return df.withColumns({
        "auto_approve": F.when(high >= 0.98, "YES").otherwise("REVIEW NEEDED"),
        "low_zone_review_pool": F.when(low >= 0.55, "YES").otherwise("MARGINAL"),
        "auto_reject": F.when(low >= 0.65, "YES").otherwise("NOT RECOMMENDED"),
    })
