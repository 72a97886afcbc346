"""Jobs around a model in production: batch scoring, monitoring, diagnosis."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewarden import vocabulary as v
from scorewarden.operators import diagnosis, monitoring, routing
from scorewarden.operators.learners import Calibrated
from scorewarden.operators.splits import retraining_periods
from scorewarden.sources.writers import write_report
from scorewarden.storage import settled


def score_batch(df: DataFrame, model: Calibrated, keys: Sequence[str], version: str, lower: float, upper: float) -> DataFrame:
    """Case, score, zone, model version and time of scoring; no label is needed."""
    zoned = routing.assign_zones(model.score(df), "pred_prob", lower, upper, v.ZONE_NAMES)
    return zoned.select(*keys, "pred_prob", "pred_zone", "zone_name").withColumns({
        "model_version": F.lit(version), "scoring_timestamp": F.current_timestamp()})


def run_monitoring(
    scored: DataFrame, baseline: DataFrame, out: str, *, label: str, score: str = "pred_prob", by: Sequence[str] = (),
    thresholds: DataFrame | None = None, trained_on: dt.date | None = None, today: dt.date | None = None, run_id: str = "latest",
) -> DataFrame:
    """Write the monitored rows of the run, and a decision with the retraining periods for each that asks for it.

    ``thresholds``: candidate sources (source, priority, lower_threshold, upper_threshold).
    """
    lower, upper = v.DEFAULT_LOWER, v.DEFAULT_UPPER
    if thresholds is not None:
        pair = monitoring.resolve_thresholds(thresholds, lower, upper).first()
        lower, upper = pair["lower_threshold"], pair["upper_threshold"]
    now = F.lit(today) if today else F.current_date()
    rows = settled(monitoring.monitor_periods(
        scored, baseline, score=score, label=label, lower=lower, upper=upper, rules=v.MONITORING, by=by,
        trained_on=F.lit(trained_on) if trained_on else None, today=now))
    write_report(rows.withColumn("monitored_at", F.current_timestamp()), f"{out}/monitoring_results", run_id)
    decisions = retraining_periods(rows.where("needs_retraining").withColumn("decided_on", now), "decided_on").select(
        *by, "decided_on", "retraining_trigger_reason", "alerts", "warnings", "development_start", "development_end",
        "policy_validation_start", "policy_validation_end", "final_holdout_start", "final_holdout_end")
    write_report(decisions, f"{out}/retraining_decisions", run_id)
    return rows


def diagnose(
    features: DataFrame, predictions: DataFrame, importance: DataFrame, windows: DataFrame, *, key: str, day: str, label: str,
    names: Sequence[str], reference: str, levels: Sequence[str], numbers: Sequence[str],
) -> dict[str, DataFrame]:
    """All diagnosis tables of a scored holdout, by name."""
    joined = diagnosis.with_features(predictions, features, key, label)
    flagged = settled(diagnosis.error_flags(joined, "actual_label", "pred_prob", "lower_threshold_used", "upper_threshold_used"))
    correlation = settled(diagnosis.reject_correlation(features, label, names))
    stability = settled(diagnosis.feature_stability(features, windows, day=day, reference=reference, features=names))
    fp, fn = (settled(diagnosis.error_profile(flagged, e, names)) for e in ("is_FP", "is_FN"))
    ranked = diagnosis.rank_importance(importance, ["gain", "weight"], "gain").select("feature", "gain_norm", "rank_gain")
    table = settled(diagnosis.diagnosis_table(ranked, correlation, stability, fp, fn, v.FEATURE_CLASSES))
    segments = settled(diagnosis.segment_errors(
        flagged, levels=[c for c in levels if c in flagged.columns], numbers=[c for c in numbers if c in flagged.columns],
        score="pred_prob", zone="pred_zone"))
    return {
        "reject_correlation": correlation, "feature_stability": stability, "fp_profile": fp, "fn_profile": fn,
        "segment_errors": segments, "zone_errors": diagnosis.zone_errors(flagged, "pred_prob", "pred_zone"),
        "feature_diagnosis": table, "worst_segments": diagnosis.worst_segments(segments),
        "challenger_plan": diagnosis.challenger_plan(
            features.sparkSession, table, "gain_norm", v.EXPERIMENTS, v.EXPERIMENT_FEATURES, v.EXPERIMENT_PROTOCOL),
        "unstable_features": diagnosis.unstable_features(table),
        "counts": flagged.agg(F.count("*").alias("rows"), F.sum("is_FP").alias("fp_count"), F.sum("is_FN").alias("fn_count")),
    }
