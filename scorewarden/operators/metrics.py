"""Ranking, calibration and threshold metrics of a (label, score) table, grouped.

Everything is computed from one row per distinct (group, score), which holds the
two label counts and the counts below that score. Ties therefore count half, as
they should, and the raw rows are read and aggregated once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewarden.functions import f1_of, flag, ratio
from scorewarden.operators.drift import DECILES
from scorewarden.operators.ordering import exact_quantiles, overlapping_sums, quick_quantiles, running_totals

METRICS = [
    "auc", "auc_pr", "brier_score", "f1", "precision", "recall", "f1_reject", "precision_reject", "recall_reject",
    "ks", "true_negative", "false_positive", "false_negative", "true_positive", "positive_ratio",
]


def score_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = (), count: str | None = None) -> DataFrame:
    """Per distinct score: ``pos`` and ``neg`` with their ``_before`` and ``_all`` sums.

    Rows without label or score, NaN included, do not take part. ``count`` names the number of rows that each stands for.
    """
    return running_totals(_judged(df, label, score), score, _label_counts(label, count), by)


def _judged(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.where(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))


def _label_counts(label: str, count: str | None = None) -> dict[str, Column]:
    n = F.lit(1) if count is None else F.col(count)
    return {"pos": (F.col(label) == 1).cast("bigint") * n, "neg": (F.col(label) != 1).cast("bigint") * n}


def classification_metrics(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), threshold: float = 0.5, count: str | None = None
) -> DataFrame:
    """One row per group with ``rows`` and every metric of ``METRICS``; ``count`` names the number of rows that each stands for.

    Label 0 is the class of interest of the ``_reject`` metrics. A group with one
    class only has auc and ks 0 but true counts. The two-class area is the
    rank sum with half weight for ties; average precision is a sum over distinct
    scores from the highest down; ks is the largest gap of the two distributions.
    """
    return _metrics_of(score_counts(df, label, score, by, count), score, by, threshold)


def overlapping_metrics(
    df: DataFrame, label: str, score: str, groups: DataFrame, on: str, by: Sequence[str] = (), threshold: float = 0.5
) -> DataFrame:
    """``classification_metrics`` per ``by`` and group, where ``groups`` names the groups of each value of ``on``: a row may be in many."""
    keys = [*by, *(c for c in groups.columns if c != on)]
    parts = overlapping_sums(
        _judged(df, label, score), score, _label_counts(label), groups, on, lambda s, n: _bucket_sums(s, n, threshold), _SUMS, by)
    both = {"p": F.max, "q": F.max, "gap": F.max}
    return _figures(parts.groupBy(*keys).agg(*(both.get(n, F.sum)(n).alias(n) for n in (c.split()[0] for c in _SUMS.split(", ")))), keys)


_SUMS = (
    "rows long, p long, q long, wins double, precision_steps double, gap double, squares double, "
    "true_positive long, false_positive long, false_negative long, true_negative long")


def _bucket_sums(s: np.ndarray, n: Mapping, threshold: float) -> dict:
    """The sums of ``_metrics_of`` over a bucket of distinct scores; the gap is the bucket's largest."""
    pos, neg, p, q, yes = n["pos"], n["neg"], n["pos_all"], n["neg_all"], s >= threshold
    above = p - n["pos_before"]
    gap = np.abs((n["pos_before"] + pos) / p - (n["neg_before"] + neg) / q).max() if p and q else None
    return {
        "rows": (pos + neg).sum(), "p": p, "q": q, "wins": (pos * (n["neg_before"] + neg / 2)).sum(),
        "precision_steps": (pos * (above / (above + q - n["neg_before"]))).sum(), "gap": gap,
        "squares": (pos * (1 - s) * (1 - s) + neg * s * s).sum(),
        "true_positive": pos[yes].sum(), "false_positive": neg[yes].sum(), "false_negative": pos[~yes].sum(), "true_negative": neg[~yes].sum()}


def _metrics_of(cells: DataFrame, score: str, by: Sequence[str], threshold: float) -> DataFrame:
    s, yes = f"`{score}`", f"`{score}` >= {threshold}D"
    sums = cells.groupBy(*by).agg(
        F.expr("sum(pos + neg) as rows"),
        F.expr("max(pos_all) as p"),
        F.expr("max(neg_all) as q"),
        F.expr("sum(double(pos) * (neg_before + neg / 2D)) as wins"),
        F.expr("sum(double(pos) * (pos_all - pos_before) / (pos_all - pos_before + neg_all - neg_before)) as precision_steps"),
        F.expr("max(abs((pos_before + pos) / double(pos_all) - (neg_before + neg) / double(neg_all)))"
               " filter (where pos_all > 0 and neg_all > 0) as gap"),
        F.expr(f"sum(pos * (1D - {s}) * (1D - {s}) + neg * {s} * {s}) as squares"),
        F.expr(f"coalesce(sum(pos) filter (where {yes}), 0) as true_positive"),
        F.expr(f"coalesce(sum(neg) filter (where {yes}), 0) as false_positive"),
        F.expr(f"coalesce(sum(pos) filter (where not {yes}), 0) as false_negative"),
        F.expr(f"coalesce(sum(neg) filter (where not {yes}), 0) as true_negative"),
    )
    return _figures(sums, by)


def _figures(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("true_positive", "false_positive", "false_negative", "true_negative"))
    values = {
        "auc": ratio(F.col("wins"), F.col("p").cast("double") * F.col("q")),
        "auc_pr": ratio(F.col("precision_steps"), F.col("p")),
        "brier_score": ratio(F.col("squares"), F.col("rows")),
        "f1": f1_of(tp, fp, fn), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn),
        "f1_reject": f1_of(tn, fn, fp), "precision_reject": ratio(tn, tn + fn), "recall_reject": ratio(tn, tn + fp),
        "ks": F.coalesce(F.col("gap"), F.lit(0.0)),
        "true_negative": tn, "false_positive": fp, "false_negative": fn, "true_positive": tp,
        "positive_ratio": ratio(F.col("p"), F.col("rows")),
    }
    return sums.select(*by, "rows", *(values[m].alias(m) for m in METRICS))


def gini(auc: Column) -> Column:
    return 2 * auc - 1


def label_coverage(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("total"), F.count(label).alias("with_label")).withColumn(
        "label_coverage_ratio", ratio(F.col("with_label"), F.col("total")))


def calibration_bands(df: DataFrame, label: str, score: str, bands: int = 10, exact: bool = True) -> DataFrame:
    """Quantile bands of the score with predicted and actual rates.

    Repeated cut points are merged, the outermost bounds are shown as 0 and 1,
    and bands without rows do not appear.
    """
    kept = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).select(
        F.col(label).cast("double").alias("y"), F.col(score).cast("double").alias("p"))
    shares = DECILES if bands == 10 else [i / bands for i in range(bands + 1)]
    points = (exact_quantiles if exact else quick_quantiles)(kept, "p", shares)
    cuts = points.selectExpr(f"array_distinct(slice(quantiles, 2, {bands - 1})) as cuts").scalar()
    index = " + ".join(f"coalesce(int(p >= get(cuts, {i})), 0)" for i in range(bands - 1))
    total = kept.agg(F.count("*")).scalar()
    return (
        kept.withColumn("cuts", cuts)
        .selectExpr("y", "p", "cuts", f"1 + {index} as decile")
        .groupBy("decile")
        .agg(
            F.count("*").alias("count"), F.avg("p").alias("predicted_avg_prob"), F.avg("y").alias("actual_approve_rate"),
            F.max("cuts").alias("cuts"),
        )
        .selectExpr(
            "decile",
            "case when decile = 1 then 0D else get(cuts, decile - 2) end as score_min",
            "coalesce(get(cuts, decile - 1), 1D) as score_max",
            "count", "predicted_avg_prob", "actual_approve_rate",
            "predicted_avg_prob - actual_approve_rate as calibration_gap",
        )
        .withColumn("ratio", ratio(F.col("count"), total))
    )


def routing_confusion(df: DataFrame, label: str, zone: str, by: Sequence[str] = ()) -> DataFrame:
    """Manual and high zones count as approval; precision and recall of rejecting, rounded to 4 places."""
    yes, good = F.col(zone) >= 1, F.col(label) == 1
    counts = df.where(F.col(label).isNotNull()).groupBy(*by).agg(
        F.count_if(yes & good).alias("true_positive"), F.count_if(~yes & ~good).alias("true_negative"),
        F.count_if(yes & ~good).alias("false_positive"), F.count_if(~yes & good).alias("false_negative"))
    tn = F.col("true_negative")
    return counts.withColumns({
        "precision_reject_zone": F.round(ratio(tn, tn + F.col("false_negative")), 4),
        "recall_reject_zone": F.round(ratio(tn, tn + F.col("false_positive")), 4)})


def class_balance(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Class counts, positive ratio, negatives per positive, and balanced weights n / (k n_class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) != 1).alias("negatives"))
    classes = flag(F.col("positives") > 0) + flag(F.col("negatives") > 0)
    return counts.withColumns({
        "positive_ratio": ratio(F.col("positives"), F.col("n")),
        "scale_weight": ratio(F.col("negatives"), F.col("positives"), 1.0),
        "weight_positive": ratio(F.col("n"), classes * F.col("positives"), None),
        "weight_negative": ratio(F.col("n"), classes * F.col("negatives"), None)})
