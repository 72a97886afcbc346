"""Rolling selection, tuning, calibrated retraining, threshold policy and blind holdout."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewarden import vocabulary as v
from scorewarden.operators import learners, metrics, registry, routing, selection, splits
from scorewarden.sources.writers import write_report, write_results
from scorewarden.storage import settled

SPREAD = ["cv_auc", "monitor_auc", "monitor_f1_reject", "monitor_ks"]
LEGACY_SPREAD = ["cv_auc", "monitor_auc", "monitor_f1_reject"]


@dataclass
class Setup:
    """What a training run needs to know about its table.

    ``tie`` is unique within a day, a number or text; ``month`` is the partition column, if there is one.
    """

    day: str
    label: str
    keys: Sequence[str]
    features: Sequence[str]
    tie: str
    month: str | None = None
    candidates: Mapping[str, tuple[str, Mapping[str, float]]] = field(
        default_factory=lambda: {k: (k, p) for k, p in v.BASE_CANDIDATES.items()})
    strategy: str = "scale_weight"
    folds: int = 5
    cv_splits: int = 2
    lowers: Sequence[float] = tuple(v.LOWER_GRID)
    uppers: Sequence[float] = tuple(v.UPPER_GRID)
    policy: Mapping[str, float] = field(default_factory=lambda: dict(v.POLICY))


def evaluate_candidates(development: DataFrame, windows: DataFrame, s: Setup, candidates=None, cv: bool = True) -> DataFrame:
    return settled(learners.rolling_cycles(
        development, windows, day=s.day, label=s.label, keys=s.keys, features=s.features,
        candidates=candidates or s.candidates, strategy=s.strategy, cv_splits=s.cv_splits, cv=cv, month=s.month))


def split_policy_holdout(oot: DataFrame, s: Setup) -> DataFrame:
    """Out-of-time rows tagged policy (first two thirds in time) or holdout. Unlabelled rows stay in their part."""
    return splits.two_thirds_split(oot, s.day, s.tie)


def retrain(development: DataFrame, s: Setup, name: str, method: str = "isotonic", candidates=None) -> learners.Calibrated:
    kind, params = (candidates or s.candidates)[name]
    return learners.fit_calibrated(
        development, s.features, s.label, kind, params, keys=s.keys, method=method, folds=s.folds, strategy=s.strategy)


def retrain_methods(development: DataFrame, s: Setup, methods: Sequence[str], candidates) -> dict[str, dict[str, learners.Calibrated]]:
    """Every candidate under every calibration method, from one set of fits."""
    return learners.fit_all_methods(
        development, s.features, s.label, candidates, keys=s.keys, methods=methods, folds=s.folds, strategy=s.strategy)


def choose_thresholds(policy: DataFrame, s: Setup) -> tuple[DataFrame, dict]:
    """The scored threshold grid and the chosen pair (one row)."""
    grid = settled(routing.score_policies(
        routing.threshold_grid(policy, s.label, "pred_prob", s.lowers, s.uppers), s.policy))
    chosen = routing.choose_policy(grid, v.DEFAULT_LOWER, v.DEFAULT_UPPER).first().asDict()
    return grid, chosen


def tune(development: DataFrame, policy: DataFrame, windows: DataFrame, s: Setup, candidates=None, methods=None) -> DataFrame:
    """Candidates x calibrations ranked by the tuning score.

    Judged on the policy part: the blind holdout must not choose the model.
    """
    chosen = {c: (kind, p) for c, kind, p in (candidates or v.TUNING_CANDIDATES)}
    cycles = evaluate_candidates(development, windows, s, chosen, cv=False)
    rolling = cycles.groupBy(F.col("model_name").alias("config_id")).agg(
        *(F.avg(f"monitor_{m}").alias(f"avg_monitor_{m}") for m in ("auc", "f1_reject", "ks", "brier")),
        F.stddev_pop("monitor_auc").alias("std_monitor_auc"),
        (F.stddev_pop("monitor_auc") + F.stddev_pop("monitor_f1_reject") + F.stddev_pop("monitor_ks")).alias("_spread"),
    ).withColumn("stability_score", F.col("_spread") / 3).drop("_spread")
    models = [(c, m, model) for c, own in retrain_methods(development, s, methods or v.TUNING_CALIBRATIONS, chosen).items() for m, model in own.items()]
    cells = learners.judged_cells(policy, [model for *_, model in models], s.features, [s.label])
    scores = [
        model.score(cells).select(F.lit(c).alias("config_id"), F.lit(m).alias("calibration_method"), s.label, "pred_prob", "_n")
        for c, m, model in models]
    held = metrics.classification_metrics(
        settled(reduce(DataFrame.unionByName, scores)), s.label, "pred_prob", ["config_id", "calibration_method"], count="_n").select(
        "config_id", "calibration_method",
        *(F.col(m).alias(f"holdout_{n}") for m, n in (("auc", "auc"), ("f1_reject", "f1_reject"), ("ks", "ks"), ("brier_score", "brier"))))
    return settled(selection.tuning_score(held.join(rolling, "config_id"), v.TUNING_WEIGHTS))


def run_training(
    development: DataFrame, oot: DataFrame, windows: DataFrame, s: Setup, *, method: str = "isotonic", tuning: bool = False,
    tuning_candidates=None, tuning_methods=None,
) -> dict[str, DataFrame]:
    """All phases; returns the result tables by name, ready for ``write_results``."""
    results: dict[str, DataFrame] = {}
    results["rolling_results"] = cycles = evaluate_candidates(development, windows, s)
    results["strategies"] = ranked = settled(selection.rank_champions(cycles, v.CHAMPION_WEIGHTS, SPREAD))
    champion = ranked.where("model_rank = 1").first()["model_name"]
    parts = split_policy_holdout(oot.where(F.col(s.label).isNotNull()), s)  # a comparison with two constants
    policy_rows, holdout_rows = (parts.where(F.col("split") == p).drop("split") for p in ("policy", "holdout"))
    candidates = dict(s.candidates)
    if tuning:
        results["tuning"] = tuned = tune(development, policy_rows, windows, s, tuning_candidates, tuning_methods)
        best = tuned.where("tuning_rank = 1").first()
        champion, method = best["config_id"], best["calibration_method"]
        candidates |= {c: (kind, p) for c, kind, p in (tuning_candidates or v.TUNING_CANDIDATES)}
    model = retrain(development, s, champion, method, candidates)
    keep = lambda df: settled(model.score(df).select(*s.keys, s.day, s.label, "pred_prob"))
    train, policy, holdout = keep(development.where(F.col(s.label).isNotNull())), keep(policy_rows), keep(holdout_rows)
    grid, chosen = choose_thresholds(policy, s)
    lower, upper, source = chosen["lower_threshold"], chosen["upper_threshold"], chosen["threshold_source"]
    stages = reduce(DataFrame.unionByName, (
        df.select(F.lit(n).alias("stage"), s.label, "pred_prob") for n, df in (("train", train), ("policy", policy), ("holdout", holdout))))
    results["stage_metrics"] = stage = settled(metrics.classification_metrics(stages, s.label, "pred_prob", ["stage"]))
    results["threshold_policies"] = grid
    results["chosen_policy"] = development.sparkSession.createDataFrame(
        [(champion, method, float(lower), float(upper), source)],
        "model_name string, calibration_method string, lower_threshold double, upper_threshold double, threshold_source string")
    for name, df in (("policy_predictions", policy), ("holdout_predictions", holdout)):
        results[name] = routing.predictions(df, [*s.keys, s.day], s.label, "pred_prob", lower, upper, v.ZONE_NAMES, source)
    results["zone_summary"] = routing.zone_summary(holdout, s.label, "pred_prob", lower, upper, v.ZONE_NAMES)
    results["deciles"] = metrics.calibration_bands(holdout, s.label, "pred_prob")
    results["routing"] = routing.routing_kpis(holdout, s.label, "pred_prob", lower, upper)
    results["diagnostics"] = selection.stage_gaps(stage_row(stage, cycles, champion if not tuning else None))
    results["feature_names"] = development.sparkSession.createDataFrame(list(enumerate(s.features)), "place int, feature string")
    return results


def stage_row(stage: DataFrame, cycles: DataFrame, model: str | None = None) -> DataFrame:
    """One row with train, monitor and holdout figures side by side."""
    at = lambda name, m: F.max(F.when(F.col("stage") == name, F.col(m)))
    row = stage.agg(
        *(at("train", m).alias(f"train_{n}") for m, n in (("auc", "auc"), ("f1_reject", "f1_reject"), ("ks", "ks"), ("brier_score", "brier"))),
        *(at("policy", m).alias(f"policy_val_{m}") for m in ("auc", "f1_reject", "ks")),
        *(at("holdout", m).alias(f"final_holdout_{n}") for m, n in (("auc", "auc"), ("f1_reject", "f1_reject"), ("ks", "ks"), ("brier_score", "brier"))))
    rolling = cycles.where(F.col("model_name") == model) if model else cycles
    means = rolling.agg(F.struct(
        *(F.avg(f"monitor_{m}").alias(m) for m in ("auc", "f1_reject", "ks", "brier"))).alias("m")).scalar()
    return row.withColumns({f"avg_monitor_{m}": means[m] for m in ("auc", "f1_reject", "ks", "brier")})


def retrain_on_decision(
    decisions: DataFrame, table: DataFrame, s: Setup, root: str, run_id: str, versions: DataFrame | None = None, **options,
) -> DataFrame:
    """Train on the periods that the latest stored retraining decision demands, and register the result.

    Opens the days from the start of development to the end of the holdout only; with ``s.month`` only those months' folders.
    Writes all result tables and a registry row under ``root`` and returns that row: the next free name after those in
    ``versions`` (baseline_name), the decision's day and reason, the chosen model with its thresholds, and the rows of each
    stage. Without a decision nothing is trained and no row comes back.
    """
    spark = table.sparkSession
    due = decisions.orderBy(F.desc("decided_on"), F.desc("development_start")).first()
    names = versions if versions is not None else spark.createDataFrame([], "baseline_name string")
    if due is None:
        return spark.createDataFrame([], REGISTRY)
    p = {k: dt.date.fromisoformat(due[k]) for k in (
        "development_start", "development_end", "policy_validation_start", "final_holdout_end")}
    first, last = p["development_start"], p["final_holdout_end"]
    rows = table.where(F.col(s.day).between(F.lit(first), F.lit(last)))
    if s.month:
        rows = rows.where(F.col(s.month).cast("string").between(f"{first:%Y-%m}", f"{last:%Y-%m}"))
    development = rows.where(F.col(s.day) <= F.lit(p["development_end"]))
    oot = rows.where(F.col(s.day) >= F.lit(p["policy_validation_start"]))
    windows = splits.rolling_windows(spark, first, p["policy_validation_start"])
    results = run_training(development, oot, windows, s, **options)
    write_results(results, root, run_id)
    chosen = results["chosen_policy"].first()
    stage = {r["stage"]: r["rows"] for r in results["stage_metrics"].select("stage", "rows").collect()}  # three rows
    version = registry.next_version(names, "baseline_name").first()[0]
    row = spark.createDataFrame([(
        version, run_id, str(due["decided_on"]), due["retraining_trigger_reason"], str(first), str(last), chosen["model_name"],
        float(chosen["lower_threshold"]), float(chosen["upper_threshold"]), *(int(stage.get(n, 0)) for n in ("train", "policy", "holdout")))], REGISTRY)
    write_report(row, f"{root}/registry", run_id)
    return row


REGISTRY = (
    "baseline_name string, run_id string, decided_on string, reason string, period_start string, period_end string, model_name string, "
    "lower_threshold double, upper_threshold double, train_rows long, policy_rows long, holdout_rows long")
