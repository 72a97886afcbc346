"""Feature and error diagnosis. Per-feature figures come from wide aggregates or one long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scorewarden.functions import flag, ratio
from scorewarden.operators.drift import long_form, smoothed_psi
from scorewarden.operators.features import classify_features
from scorewarden.operators.ordering import exact_quantiles, quick_quantiles
from scorewarden.operators.splits import tag_windows


def _feature_rows(stats: DataFrame, features: Sequence[str], fields: dict[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """One wide aggregate row to one row per feature; ``fields`` maps field -> column prefix."""
    rows = F.array(*(
        F.struct(F.lit(f).alias("feature"), *(F.col(f"{prefix}{i}").cast("double").alias(n) for n, prefix in fields.items()))
        for i, f in enumerate(features)))
    return stats.select(*keys, F.inline(rows))


def reject_correlation(
    df: DataFrame, label: str, features: Sequence[str], exact: bool = True, places: int = 4
) -> DataFrame:
    """Correlation of each feature (null as 0) with rejection, and reject rates at and beyond its quartiles."""
    kept = df.where(F.col(label).isNotNull()).select(
        (1 - F.col(label)).cast("double").alias("_reject"),
        *(F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features))
    values = long_form(kept, features, ["_reject"])
    quartiles = (exact_quantiles if exact else quick_quantiles)(values, "value", [0.25, 0.75], ["feature"])
    stats = values.join(F.broadcast(quartiles), "feature").groupBy("feature").agg(  # one row per feature
        F.corr("value", "_reject").alias("c"), F.avg("_reject").alias("all"),
        F.avg(F.when(F.col("value") <= F.col("quantiles")[0], F.col("_reject"))).alias("low"),
        F.avg(F.when(F.col("value") >= F.col("quantiles")[1], F.col("_reject"))).alias("high"),
        F.max(F.col("quantiles")[0] != F.col("quantiles")[1]).alias("spread"))
    correlation = F.coalesce(F.nanvl("c", F.lit(0.0)), F.lit(0.0))
    low, high = (F.when(F.col("spread"), F.col(c)).otherwise(F.col("all")) for c in ("low", "high"))
    return stats.select(
        "feature",
        F.round(correlation, places).alias("corr_with_reject"), F.round(F.abs(correlation), places).alias("abs_corr_with_reject"),
        F.round(low, places).alias("reject_rate_q25"), F.round(high, places).alias("reject_rate_q75"),
        F.round(high - low, places).alias("reject_lift_q75_vs_q25"))


def window_means(df: DataFrame, windows: DataFrame, day: str, features: Sequence[str]) -> DataFrame:
    """(window_id, feature, mean to 4 places) over train and monitor days of each window."""
    tagged = tag_windows(df.select(day, *features), windows, day)
    stats = tagged.groupBy("window_id").agg(*(F.round(F.avg(F.col(f).cast("double")), 4).alias(f"m{i}") for i, f in enumerate(features)))
    return _feature_rows(stats, features, {"mean": "m"}, ["window_id"])


def feature_stability(
    df: DataFrame, windows: DataFrame, *, day: str, reference: str, features: Sequence[str], exact: bool = True
) -> DataFrame:
    """Moments and missing rates of both sides, smoothed PSI, variation over windows, and the unstable flag.

    ``reference`` is a boolean column: true for development rows.
    """
    dev = F.col(reference)
    fields = {}
    aggregates = []
    for i, f in enumerate(features):
        value = F.col(f).cast("double")
        for side, test in (("dev", dev), ("oot", ~dev)):
            inside = F.when(test, value)
            aggregates += [F.avg(inside).alias(f"{side}_mean{i}"), F.stddev(inside).alias(f"{side}_std{i}"),
                           ratio(F.count_if(test & value.isNull()), F.count_if(test)).alias(f"{side}_missing_rate{i}")]
            fields |= {f"{side}_{m}": f"{side}_{m}" for m in ("mean", "std", "missing_rate")}
    sides = _feature_rows(df.agg(*aggregates), features, fields)
    means = window_means(df, windows, day, features).groupBy("feature").agg(
        F.count("mean").alias("n"), F.avg("mean").alias("m"), F.stddev_pop("mean").alias("s"))
    variation = means.select("feature", F.when((F.col("n") > 1) & (F.col("m") != 0), F.col("s") / F.col("m")).otherwise(0.0).alias("temporal_cv"))
    psi = smoothed_psi(df, features, reference, exact).withColumnRenamed("psi", "psi_dev_vs_oot")
    # every table here has one row per feature
    joined = sides.join(F.broadcast(psi), "feature").join(F.broadcast(variation), "feature", "left")
    shift = F.abs(F.col("oot_mean") - F.col("dev_mean")) / (F.col("dev_std") + 1e-8)
    return joined.withColumns({
        "temporal_cv": F.coalesce("temporal_cv", F.lit(0.0)),
        "mean_shift_zscore": shift,
        "missing_rate_change": F.col("oot_missing_rate") - F.col("dev_missing_rate"),
    }).withColumn("is_unstable", F.coalesce(
        (F.col("psi_dev_vs_oot") > 0.1) | (F.col("mean_shift_zscore") > 0.5) | (F.col("temporal_cv") > 0.15), F.lit(False)))


def error_flags(df: DataFrame, label: str, score: str, lower: str, upper: str) -> DataFrame:
    """Automatic approvals of rejects are false positives, automatic rejections of approvals false negatives."""
    reject = F.col(label) == 0
    low, high = F.col(score) < F.col(lower), F.col(score) >= F.col(upper)
    return df.withColumns({
        "actual_reject": flag(reject), "pred_reject": flag(low), "pred_approve": flag(high),
        "is_FP": flag(high & reject), "is_FN": flag(low & ~reject), "is_correct": flag((high & ~reject) | (low & reject))})


def with_features(predictions: DataFrame, features: DataFrame, key: str, label: str) -> DataFrame:
    """Left join of predictions to features on the case; clashing feature columns get the suffix _gold."""
    clash = {c: f"{c}_gold" for c in features.columns if c in predictions.columns and c not in (key, label)}
    return predictions.join(features.drop(label).withColumnsRenamed(clash), key, "left")


def held_out(features: DataFrame, predictions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Feature rows whose columns occur among the predictions."""
    return features.join(predictions.select(*columns).distinct(), list(columns), "left_semi")


def _bins(df: DataFrame, numbers: Sequence[str], exact: bool, bins: int = 5) -> DataFrame:
    """(…, segment_feature, segment_value) for quantile bins (a, b], the lowest bin closed on both sides."""
    shares = [i / bins for i in range(bins + 1)]
    ids = [c for c in df.columns if c not in numbers]
    values = long_form(df, numbers, ids).where("value is not null and not isnan(value)")
    cuts = (exact_quantiles if exact else quick_quantiles)(values, "value", shares, ["feature"]).selectExpr(
        "feature", "array_distinct(quantiles) as edges")
    index = " + ".join(f"coalesce(int(value > get(edges, {i})), 0)" for i in range(1, bins + 1))
    return values.join(F.broadcast(cuts), "feature").where("size(edges) > 1").selectExpr(  # one row per feature
        *ids, "feature as segment_feature", f"cast({index} as string) as segment_value")


def segment_errors(
    df: DataFrame, *, levels: Sequence[str], numbers: Sequence[str], score: str, zone: str, minimum: int = 30,
    exact: bool = True, places: int = 4,
) -> DataFrame:
    """Error rates per segment of at least ``minimum`` rows; null levels are left out.

    Numeric segments are named by the number of their quintile bin, 0 to 4.
    """
    measures = ["actual_reject", "is_FP", "is_FN", score, zone]
    total = df.agg(F.count("*")).scalar()
    parts = []
    if levels:
        cast = df.select(*measures, *(F.col(c).cast("string").alias(c) for c in levels))
        parts.append(cast.unpivot(measures, list(levels), "segment_feature", "segment_value").where("segment_value is not null"))
    if numbers:
        parts.append(_bins(df.select(*measures, *numbers), numbers, exact))
    rows = reduce(DataFrame.unionByName, parts)
    share = lambda code: F.round(F.avg(flag(F.col(zone) == code)), places)
    rate = lambda c: F.round(F.avg(c), places)
    return rows.groupBy("segment_feature", "segment_value").agg(
        F.count("*").alias("count"), F.round(ratio(F.count("*"), total), places).alias("count_pct"),
        rate("actual_reject").alias("reject_rate"), rate("is_FP").alias("fp_rate"), rate("is_FN").alias("fn_rate"),
        F.sum("is_FP").alias("fp_count"), F.sum("is_FN").alias("fn_count"), rate(score).alias("avg_pred_prob"),
        share(2).alias("high_zone_pct"), share(1).alias("manual_zone_pct"), share(0).alias("low_zone_pct"),
    ).where(F.col("count") >= minimum)


def error_profile(df: DataFrame, error: str, features: Sequence[str]) -> DataFrame:
    """Mean, sample deviation and missing rate of each feature over the error rows and over all rows."""
    wrong = F.col(error) == 1
    aggregates = [F.count_if(wrong).alias("errors"), F.count("*").alias("n")]
    fields = {m: m for m in ("overall_mean", "overall_std", "error_mean", "error_std", "error_missing_rate", "overall_missing_rate")}
    for i, f in enumerate(features):
        value = F.col(f).cast("double")
        inside = F.when(wrong, value)
        aggregates += [
            F.avg(value).alias(f"overall_mean{i}"), F.stddev(value).alias(f"overall_std{i}"),
            F.avg(inside).alias(f"error_mean{i}"), F.stddev(inside).alias(f"error_std{i}"),
            ratio(F.count_if(wrong & value.isNull()), F.count_if(wrong), None).alias(f"error_missing_rate{i}"),
            ratio(F.count_if(value.isNull()), F.count("*")).alias(f"overall_missing_rate{i}")]
    rows = _feature_rows(df.agg(*aggregates), features, fields, ["errors"])
    gap = F.col("error_mean") - F.col("overall_mean")
    return rows.withColumn("mean_diff", gap).withColumn(
        "mean_diff_zscore", gap / (F.col("overall_std") + 1e-8)).withColumnRenamed("errors", "error_count")


def zone_errors(df: DataFrame, score: str, zone: str, places: int = 4) -> DataFrame:
    """Error counts and rates per zone."""
    total = df.agg(F.count("*")).scalar()
    rate = lambda c: F.round(F.avg(c), places)
    return df.groupBy(zone).agg(
        F.count("*").alias("count"), F.round(ratio(F.count("*"), total), places).alias("count_pct"),
        F.sum("actual_reject").alias("actual_reject_count"), rate("actual_reject").alias("actual_reject_rate"),
        F.sum("is_FP").alias("fp_count"), rate("is_FP").alias("fp_rate"),
        F.sum("is_FN").alias("fn_count"), rate("is_FN").alias("fn_rate"),
        rate(score).alias("avg_pred_prob"), F.round(F.stddev(score), places).alias("std_pred_prob"),
        F.round(1 - F.avg("actual_reject"), places).alias("_approve"),
    ).withColumns({
        "precision_approve": F.when(F.col(zone) == 2, F.col("_approve")),
        "precision_reject": F.when(F.col(zone) == 0, F.col("actual_reject_rate")),
    }).drop("_approve")


def rank_importance(df: DataFrame, measures: Sequence[str], rank_by: str) -> DataFrame:
    """Each measure as a share of its total, and the rank (ties share the best) by one of them. One row per feature."""
    everything = W.partitionBy()
    shares = {f"{m}_norm": ratio(F.col(m), F.sum(m).over(everything)) for m in measures}
    return df.withColumns(shares).withColumn(f"rank_{rank_by}", F.rank().over(W.orderBy(F.desc(f"{rank_by}_norm"))))


def diagnosis_table(
    importance: DataFrame, correlation: DataFrame, stability: DataFrame, fp_profile: DataFrame, fn_profile: DataFrame,
    classes: Sequence[tuple[Sequence[str], str]] = (),
) -> DataFrame:
    """All findings of a feature in one row, with its class by name."""
    def take(df: DataFrame, *columns: Column | str) -> DataFrame:
        return F.broadcast(df.select("feature", *columns))  # one row per feature
    return (
        importance
        .join(take(correlation, "corr_with_reject", "abs_corr_with_reject", "reject_lift_q75_vs_q25"), "feature", "left")
        .join(take(stability, "psi_dev_vs_oot", "mean_shift_zscore", "temporal_cv", "is_unstable"), "feature", "left")
        .join(take(fp_profile, F.col("mean_diff_zscore").alias("fp_feature_shift")), "feature", "left")
        .join(take(fn_profile, F.col("mean_diff_zscore").alias("fn_feature_shift")), "feature", "left")
        .transform(lambda df: classify_features(df, "feature", classes, "feature_class"))
    )


def unstable_features(diagnosis: DataFrame) -> DataFrame:
    return diagnosis.where("is_unstable").select("feature", "psi_dev_vs_oot", "mean_shift_zscore", "temporal_cv")


def weak_features(diagnosis: DataFrame, share: str, limit: float = 0.01) -> DataFrame:
    return diagnosis.where(F.col(share) < limit).select("feature", share)


def top_reject_features(diagnosis: DataFrame, k: int = 10) -> DataFrame:
    return diagnosis.orderBy(F.desc("abs_corr_with_reject"), "feature").limit(k).select("feature", "corr_with_reject")


def worst_segments(segments: DataFrame, limit: float = 0.05, k: int = 10) -> DataFrame:
    return segments.where(F.col("fp_rate") > limit).orderBy(F.desc("fp_rate"), "segment_feature", "segment_value").limit(k)


def challenger_plan(
    spark: SparkSession, diagnosis: DataFrame, share: str, experiments: Sequence[tuple], added: Sequence[str] = (), protocol: Mapping[str, str] | None = None,
) -> DataFrame:
    """Planned experiments; the clean-up ones drop the features found unstable or weak, others add ``added``.

    ``experiments``: (id, learner, calibration, adds features, drops features, hypothesis, target metric). ``protocol`` says
    how all of them are judged. The lists are at most as long as the feature list.
    """
    drop = diagnosis.where(F.col("is_unstable") | (F.col(share) < 0.01)).agg(
        F.array_sort(F.collect_set("feature")).alias("f")).scalar()
    planned = spark.createDataFrame(
        list(experiments), "challenger_id string, model_type string, calibration string, adds boolean, drops boolean, hypothesis string, target_metric string")
    none = F.array().cast("array<string>")
    judged = F.create_map(*(F.lit(x) for pair in (protocol or {}).items() for x in pair)).cast("map<string,string>")
    return planned.select(
        "challenger_id", "model_type", "calibration", "hypothesis", "target_metric",
        F.when(F.col("adds"), F.array(*map(F.lit, added)).cast("array<string>")).otherwise(none).alias("add_features"),
        F.when(F.col("drops"), drop).otherwise(none).alias("remove_features"), judged.alias("protocol"), F.lit("planned").alias("status"))
