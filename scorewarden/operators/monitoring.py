"""Production monitoring of scored periods, and what triggers retraining."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewarden.functions import joined_reasons, month_number
from scorewarden.operators.drift import attach, psi_by_group, score_distribution, zone_shift
from scorewarden.operators.metrics import classification_metrics, label_coverage
from scorewarden.storage import settled


def trigger_columns(
    rules: Mapping[str, float], *, auc: str = "auc", f1_reject: str = "f1_reject", psi: str = "score_psi",
    trained_on: str | None = None, today: Column | None = None,
) -> dict[str, Column]:
    """``needs_retraining`` and ``retraining_trigger_reason``. A metric that is null does not trigger."""
    def low(name: str, label: str, limit: float) -> tuple[Column, Column]:
        return F.col(name) < limit, F.format_string(f"{label}=%.4f < {limit}", F.col(name))
    reasons = [
        low(auc, "AUC", rules["min_auc"]), low(f1_reject, "F1_reject", rules["min_f1_reject"]),
        (F.col(psi) >= rules["max_score_psi"], F.format_string(f"Score PSI=%.4f >= {rules['max_score_psi']}", F.col(psi))),
    ]
    if trained_on:
        # calendar months apart, whatever the day of the month
        months = month_number(today if today is not None else F.current_date()) - month_number(F.col(trained_on))
        reasons.append((months >= rules["retrain_months"], F.format_string("Time: %d months since last training", months)))
    text = joined_reasons(*reasons)
    return {"needs_retraining": text != "", "retraining_trigger_reason": text}


def retrain_trigger(df: DataFrame, rules: Mapping[str, float], **columns) -> DataFrame:
    return df.withColumns(trigger_columns(rules, **columns))


def alert_columns(rules: Mapping[str, float]) -> dict[str, Column]:
    """Arrays of alert and warning codes of a monitored row; nulls raise nothing."""
    auc, f1r, psi, shift = F.col("auc"), F.col("f1_reject"), F.col("score_psi"), F.col("max_shift")
    pick = lambda *pairs: F.array_compact(F.array(*(F.when(test, code) for test, code in pairs)))
    return {
        "alerts": pick(
            (psi >= rules["max_score_psi"], "SCORE_PSI"), (auc < rules["min_auc"], "AUC"),
            (f1r < rules["min_f1_reject"], "F1_REJECT")),
        "warnings": pick(
            (shift >= rules["warning_zone_shift"], "ZONE_SHIFT"),
            ((psi >= rules["warning_score_psi"]) & (psi < rules["max_score_psi"]), "SCORE_PSI"),
            ((auc >= rules["min_auc"]) & (auc < rules["warning_auc"]), "AUC")),
    }


def monitor_periods(
    scored: DataFrame, baseline: DataFrame, *, score: str, label: str, lower: float, upper: float,
    rules: Mapping[str, float], by: Sequence[str] = (), trained_on: Column | None = None, today: Column | None = None,
    exact: bool = True,
) -> DataFrame:
    """One row per period (and model): score distribution, zone mix and shift, score PSI against
    the baseline, metrics of the labelled rows, alerts, warnings and the retraining decision.

    Thresholds of 0 are thresholds, not "unset". Metrics are null where a period
    has no label of one of the classes. Both tables are read once; their few columns
    are settled for the passes over them.
    """
    scored, baseline = settled(scored.select(*by, score, label)), settled(baseline.select(score))
    row = zone_shift(scored, score, baseline, lower, upper, by, rules["warning_zone_shift"])
    row = attach(row, score_distribution(scored, score, by, exact).drop("n", "n_nan").withColumnsRenamed(
        {c: f"score_{c}" for c in ("mean", "std", "median", "min", "max", "q25", "q75")}), by)
    row = attach(row, label_coverage(scored, label, by).drop("total"), by)
    if by:
        psi = psi_by_group(scored, score, baseline, by, exact)
    else:
        psi = psi_by_group(scored.withColumn("_all", F.lit(0)), score, baseline, ["_all"], exact).drop("_all")
    row = attach(row, psi.withColumnRenamed("psi", "score_psi"), by)
    metrics = classification_metrics(scored, label, score, by)
    both = (F.col("positive_ratio") > 0) & (F.col("positive_ratio") < 1)
    row = attach(row, metrics.select(
        *by, *(F.when(both, F.col(m)).alias(m) for m in ("auc", "ks")), "f1_reject", "brier_score", "positive_ratio"), by)
    row = row.withColumns(alert_columns(rules))
    if trained_on is not None:
        row = row.withColumn("last_training_date", trained_on)
    return row.withColumns(trigger_columns(
        rules, trained_on="last_training_date" if trained_on is not None else None, today=today))


def batch_summary(scored: DataFrame, score: str, zone: str, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by).agg(
        F.count("*").alias("total_records"),
        *(F.count_if(F.col(zone) == code).alias(f"zone_{name}_count") for name, code in (("high", 2), ("manual", 1), ("low", 0))),
        F.avg(score).alias("score_mean"), F.stddev_pop(score).alias("score_std"))


def resolve_thresholds(sources: DataFrame, default_lower: float, default_upper: float) -> DataFrame:
    """First complete (lower, upper) pair in order of ``priority``, else the defaults; 0 is a valid threshold."""
    complete = F.col("lower_threshold").isNotNull() & F.col("upper_threshold").isNotNull()
    pick = F.min_by(F.struct("lower_threshold", "upper_threshold", "source"), "priority")
    return sources.where(complete).agg(pick.alias("p")).select(
        F.coalesce(F.col("p.lower_threshold"), F.lit(default_lower)).alias("lower_threshold"),
        F.coalesce(F.col("p.upper_threshold"), F.lit(default_upper)).alias("upper_threshold"),
        F.coalesce(F.col("p.source"), F.lit("default")).alias("source"))
