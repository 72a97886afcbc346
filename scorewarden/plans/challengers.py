"""Challengers against the active baseline, all judged on the same holdout rows, and the final decision."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewarden import vocabulary as v
from scorewarden.operators import learners, metrics, routing, selection
from scorewarden.plans.training import Setup, evaluate_candidates, retrain_methods, run_training
from scorewarden.sources.writers import read_results
from scorewarden.storage import settled

METRIC_COLUMNS = [
    "auc", "f1_reject", "brier_score", "ks", "precision_reject", "recall_reject", "low_zone_reject_precision",
    "high_zone_approve_precision", "high_zone_ratio", "manual_review_ratio", "low_zone_ratio", "human_review_workload_ratio",
]
LOWER_IS_BETTER = ["brier_score", "manual_review_ratio", "human_review_workload_ratio"]


def holdout_figures(predictions: DataFrame, name: str) -> DataFrame:
    """Classifier and routing figures of a predictions table, one row."""
    named = predictions.withColumn("challenger", F.lit(name))
    scores = metrics.classification_metrics(named, "actual_label", "pred_prob", ["challenger"])
    zones = routing.routing_kpis_from_zones(named, "actual_label", "pred_zone", ["challenger"]).drop("n")
    return scores.join(zones, "challenger")


def upgrade_rows(challengers: DataFrame, baseline: DataFrame) -> DataFrame:
    """Decision per challenger. ``overfitting_penalty`` comes with the challenger's rolling results."""
    base = baseline.select(F.struct(*METRIC_COLUMNS).alias("b")).scalar()
    both = challengers.withColumnsRenamed({m: f"ch_{m}" for m in METRIC_COLUMNS}).withColumns(
        {f"base_{m}": base[m] for m in METRIC_COLUMNS})
    return selection.upgrade_decision(both, v.UPGRADE)


def comparison(challenger: DataFrame, baseline: DataFrame) -> DataFrame:
    return selection.compare_metrics(
        selection.long_metrics(baseline, [], METRIC_COLUMNS), selection.long_metrics(challenger, [], METRIC_COLUMNS), LOWER_IS_BETTER)


def overfitting_penalty(cycles: DataFrame, holdout_auc: DataFrame) -> DataFrame:
    """One row: how far the gaps and the spread exceed their limits."""
    c = v.DECISION
    over = lambda x, limit: F.greatest(x - limit, F.lit(0.0))
    row = cycles.agg(F.avg("train_auc").alias("t"), F.avg("monitor_auc").alias("m"), F.stddev_pop("monitor_auc").alias("s"))
    penalty = c["overfitting_weight"] * (
        over(F.col("t") - F.col("m"), c["max_train_monitor_auc_gap"])
        + over(F.abs(F.col("m") - holdout_auc.scalar()), c["max_monitor_holdout_auc_gap"])
        + over(F.col("s"), c["max_stability_score"]))
    return row.select(penalty.alias("overfitting_penalty"))


def pruned_challenger(
    development: DataFrame, oot: DataFrame, windows: DataFrame, s: Setup, drop: list[str], baseline: DataFrame, **options
) -> dict[str, DataFrame]:
    """The whole training run without some features, judged against the baseline's holdout figures."""
    pruned = Setup(**{**s.__dict__, "features": [f for f in s.features if f not in drop]})
    results = run_training(development, oot, windows, pruned, **options)
    figures = settled(holdout_figures(results["holdout_predictions"], "pruned"))
    winner = results["strategies"].where("model_rank = 1").select("model_name").scalar()
    cycles = results["rolling_results"].where(F.col("model_name") == winner)
    penalty = overfitting_penalty(cycles, figures.select("auc"))
    results["decision"] = settled(upgrade_rows(figures.withColumn("overfitting_penalty", penalty.scalar()), baseline))
    results["comparison"] = comparison(figures, baseline)
    results["stability"] = selection.rolling_stability(results["rolling_results"])
    return results


def decision_tuning_challenger(
    development: DataFrame, policy: DataFrame, holdout: DataFrame, windows: DataFrame, s: Setup, baseline: DataFrame,
    candidates=None, methods=None,
) -> dict[str, DataFrame]:
    """Candidates x calibrations, each with its own thresholds, ranked by the decision score; all are judged in the same jobs."""
    chosen = {c: (kind, p) for c, kind, p in (candidates or v.DECISION_CANDIDATES)}
    cycles = evaluate_candidates(development, windows, s, chosen, cv=False)
    rolling = cycles.groupBy(F.col("model_name").alias("config_id")).agg(
        F.avg("train_auc").alias("avg_train_auc"),
        *(F.avg(f"monitor_{m}").alias(f"avg_monitor_{m}") for m in ("auc", "f1_reject", "ks", "brier")),
        F.stddev_pop("monitor_auc").alias("stability_score"))
    group = ["config_id", "calibration_method"]
    retrained = retrain_methods(development, s, methods or v.DECISION_CALIBRATIONS, chosen)
    models = [(c, m, model) for c, own in retrained.items() for m, model in own.items()]
    names = development.sparkSession.createDataFrame([(c, m) for c, m, _ in models], "config_id string, calibration_method string")

    def judged(df: DataFrame) -> DataFrame:
        """The scores of all candidates and calibrations, each with its number of rows."""
        cells = learners.judged_cells(df, [model for *_, model in models], s.features, [s.label])
        return settled(reduce(DataFrame.unionByName, (
            model.score(cells).select(F.lit(c).alias("config_id"), F.lit(m).alias("calibration_method"), s.label, "pred_prob", "_n") for c, m, model in models)))

    grid = settled(routing.score_policies(
        routing.threshold_grid(judged(policy), s.label, "pred_prob", s.lowers, s.uppers, group, count="_n"), s.policy, group))
    best = routing.choose_policy(grid, v.DEFAULT_LOWER, v.DEFAULT_UPPER, group)
    pairs = settled(names.join(best, group, "left").select(
        *group, F.coalesce("lower_threshold", F.lit(v.DEFAULT_LOWER)).alias("best_lower_threshold"),
        F.coalesce("upper_threshold", F.lit(v.DEFAULT_UPPER)).alias("best_upper_threshold")))  # a row per candidate and calibration
    held = settled(judged(holdout).join(F.broadcast(pairs), group))
    zones = routing.routing_kpis(
        held, s.label, "pred_prob", F.col("best_lower_threshold"), F.col("best_upper_threshold"), group, count="_n").drop("n")
    test = metrics.classification_metrics(held, s.label, "pred_prob", group, count="_n").select(
        *group, F.col("auc").alias("holdout_auc"), F.col("f1_reject").alias("holdout_f1_reject"),
        F.col("brier_score").alias("holdout_brier"), F.col("ks").alias("holdout_ks"), "precision_reject", "recall_reject")
    fit = metrics.classification_metrics(judged(development.where(F.col(s.label).isNotNull())), s.label, "pred_prob", group, count="_n").select(
        *group, F.col("brier_score").alias("train_brier"))
    rows = settled(pairs.join(zones, group, "left").fillna(0.0, [c for c in zones.columns if c not in group]).join(test, group, "left").join(fit, group, "left"))
    scored = settled(selection.decision_score(rows.join(rolling, "config_id"), v.DECISION))
    figures = scored.withColumnsRenamed({
        "holdout_auc": "auc", "holdout_f1_reject": "f1_reject", "holdout_brier": "brier_score", "holdout_ks": "ks"}).withColumn(
        "challenger", F.concat_ws("/", "config_id", "calibration_method"))
    return {"candidates": scored, "threshold_policies": grid, "rolling_results": cycles,
            "decision": upgrade_rows(figures, baseline)}


def compare_stored(spark, root: str, name: str, baseline: DataFrame) -> DataFrame:
    """The comparison of every stored run with a baseline, rebuilt from its figures: (run_id, metric, values, delta, verdict)."""
    figures = read_results(spark, root, name)
    known = [m for m in METRIC_COLUMNS if m in figures.columns]
    return selection.compare_metrics(
        selection.long_metrics(baseline, [], known), selection.long_metrics(figures, ["run_id"], known), LOWER_IS_BETTER)


def final_decision(decisions: DataFrame, baseline: DataFrame) -> DataFrame:
    """One row: the model to run with its own thresholds.

    ``decisions``: (challenger, upgrade_candidate, upgrade_reason, lower_threshold, upper_threshold).
    """
    return selection.resolve_decision(
        selection.best_challenger(decisions), baseline,
        decisions.select("challenger", "lower_threshold", "upper_threshold", "upgrade_reason"))


def evidence(predictions: DataFrame) -> dict[str, DataFrame]:
    """The numbers behind the decision's figures."""
    return {
        "confusion": metrics.routing_confusion(predictions, "actual_label", "pred_zone"),
        "zone_outcomes": routing.zone_outcomes(predictions, "actual_label", "pred_zone"),
        "routing": selection.recommendation(routing.routing_kpis_from_zones(predictions, "actual_label", "pred_zone")),
    }
