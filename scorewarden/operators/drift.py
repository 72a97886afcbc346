"""Population stability, unseen categories and distribution profiles.

Two tables are compared as one table with a boolean ``reference`` column, so a
single scan serves both sides and every column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scorewarden.functions import flag, ratio, score_zone
from scorewarden.operators.ordering import exact_quantiles, quick_quantiles

DECILES = [i / 10 for i in range(11)]
SIGNIFICANT, CRITICAL = 0.1, 0.25


def long_form(df: DataFrame, columns: Sequence[str], ids: Sequence[str], kind: str = "double") -> DataFrame:
    """(ids, feature, value): one row per row and column, streamed into the next aggregate."""
    cast = df.select(*ids, *(F.col(c).cast(kind).alias(c) for c in columns))
    return cast.unpivot(list(ids), list(columns), "feature", "value")


def with_flags(df: DataFrame, psi: str = "psi") -> DataFrame:
    return df.withColumns({
        "is_significant": F.col(psi) >= SIGNIFICANT, "is_critical": F.col(psi) >= CRITICAL})


# SQL of the index: shares of aligned arrays, each share at least a small floor
PSI_TERMS = (
    "transform(zip_with({e}, {a}, (e, a) -> struct(greatest(e, 1e-10D) as e, greatest(a, 1e-10D) as a)),"
    " p -> (p.a - p.e) * ln(p.a / p.e))"
)
PSI_SUM = f"aggregate({PSI_TERMS}, 0D, (s, t) -> s + t)"


# ---- categories ---------------------------------------------------------------
def category_shares(df: DataFrame, columns: Sequence[str], reference: str) -> DataFrame:
    """(feature, value, expected, actual): shares on both sides; null is a category of its own."""
    counts = long_form(df, columns, [reference], "string").groupBy("feature", "value").agg(
        F.sum(flag(F.col(reference))).alias("e"), F.sum(flag(~F.col(reference))).alias("a"))
    totals = counts.groupBy("feature").agg(F.sum("e").alias("en"), F.sum("a").alias("an"))
    return counts.join(F.broadcast(totals), "feature").select(  # one row per compared column
        "feature", "value", ratio(F.col("e"), F.col("en")).alias("expected"), ratio(F.col("a"), F.col("an")).alias("actual"),
        F.col("e").alias("expected_count"), F.col("a").alias("actual_count"))


def category_psi(df: DataFrame, columns: Sequence[str], reference: str) -> DataFrame:
    """Per column: psi, number of categories only on the actual side, and their share of it."""
    unseen = (F.col("expected_count") == 0) & (F.col("actual_count") > 0)
    e, a = F.greatest("expected", F.lit(1e-10)), F.greatest("actual", F.lit(1e-10))
    return category_shares(df, columns, reference).groupBy("feature").agg(
        F.sum((a - e) * F.log(a / e)).alias("psi"),
        F.sum(flag(unseen)).alias("unseen_count"),
        F.sum(F.when(unseen, F.col("actual")).otherwise(0.0)).alias("unseen_ratio"),
    )


def unseen_values(df: DataFrame, columns: Sequence[str], reference: str) -> DataFrame:
    """(feature, value, n) of non-null values that only occur on the actual side."""
    return category_shares(df, columns, reference).where(
        F.col("value").isNotNull() & (F.col("expected_count") == 0) & (F.col("actual_count") > 0)
    ).select("feature", "value", F.col("actual_count").alias("n"))


def unseen_summary(df: DataFrame, columns: Sequence[str], reference: str) -> DataFrame:
    """Per column: distinct values on both sides, and the rows and share with unseen values."""
    shares = category_shares(df, columns, reference)
    known = F.col("value").isNotNull()
    unseen = known & (F.col("expected_count") == 0)
    return shares.groupBy("feature").agg(
        F.sum(flag(known & (F.col("expected_count") > 0))).alias("dev_category_count"),
        F.sum(flag(known & (F.col("actual_count") > 0))).alias("oot_category_count"),
        F.sum(flag(unseen)).alias("unseen_categories"),
        F.sum(F.when(unseen, F.col("actual_count")).otherwise(0)).alias("unseen_count"),
        ratio(F.sum(F.when(unseen, F.col("actual_count")).otherwise(0)), F.sum("actual_count")).alias("unseen_ratio"),
    )


# ---- numbers ------------------------------------------------------------------
def _quantiles(df: DataFrame, value: str, shares: Sequence[float], by: Sequence[str], exact: bool) -> DataFrame:
    return (exact_quantiles if exact else quick_quantiles)(df, value, shares, by)


def _bin_index(value: str, edges: str, size: int) -> str:
    """SQL: how many of the inner edges (all but the first and last) are at or below the value."""
    return " + ".join(f"int({value} >= {edges}[{i}])" for i in range(1, size - 1))


def bin_counts(bins: int, name: str, where: str | None = None) -> Column:
    """Aggregate: array with the number of rows in bins 0 .. bins - 1 of column ``bin``."""
    test = f" and {where}" if where else ""
    return F.expr("array(" + ", ".join(f"count_if(bin = {i}{test})" for i in range(bins)) + ")").alias(name)


def numeric_bins(df: DataFrame, columns: Sequence[str], reference: str, exact: bool = True) -> DataFrame:
    """Per column: decile edges of the reference side and the counts of both sides in those bins.

    Bins are [edge, next edge) with open ends. The edge table has one row per
    compared column; a row finds its bin by comparing with nine array elements.
    """
    values = long_form(df, columns, [reference]).where("value is not null and not isnan(value)")
    edges = _quantiles(values.where(F.col(reference)), "value", DECILES, ["feature"], exact).select(
        "feature", F.col("quantiles").alias("edges"))
    return (
        values.join(F.broadcast(edges), "feature")
        .selectExpr("feature", "edges", reference, f"{_bin_index('value', 'edges', 11)} as bin")
        .groupBy("feature")
        .agg(
            F.max("edges").alias("edges"),
            bin_counts(10, "expected_counts", reference), bin_counts(10, "actual_counts", f"not {reference}"),
        )
    )


def _shares(counts: str) -> str:
    return f"transform({counts}, k -> k / aggregate({counts}, 0L, (s, x) -> s + x))"


def numeric_psi(df: DataFrame, columns: Sequence[str], reference: str, exact: bool = True) -> DataFrame:
    """(feature, psi); an empty side gives 0."""
    total = "aggregate({}, 0L, (s, x) -> s + x)"
    both = f"{total.format('expected_counts')} > 0 and {total.format('actual_counts')} > 0"
    psi = PSI_SUM.format(e=_shares("expected_counts"), a=_shares("actual_counts"))
    return numeric_bins(df, columns, reference, exact).selectExpr(
        "feature", f"case when {both} then {psi} else 0D end as psi")


def numeric_psi_bins(df: DataFrame, columns: Sequence[str], reference: str, exact: bool = True) -> DataFrame:
    """(feature, bin_index, expected_ratio, actual_ratio, bin_psi): the parts the index is made of."""
    e, a = _shares("expected_counts"), _shares("actual_counts")
    return (
        numeric_bins(df, columns, reference, exact)
        .selectExpr("feature", f"{e} as e", f"{a} as a")
        .selectExpr("feature", f"posexplode(arrays_zip(e, a, {PSI_TERMS.format(e='e', a='a')})) as (bin_index, p)")
        .selectExpr("feature", "bin_index", "p.e as expected_ratio", "p.a as actual_ratio", "p.`2` as bin_psi")
    )


def smoothed_psi(df: DataFrame, columns: Sequence[str], reference: str, exact: bool = True) -> DataFrame:
    """Diagnosis variant: bins between the distinct deciles of the *actual* side, closed at
    both ends, values outside dropped, one added to every count."""
    values = long_form(df, columns, [reference]).where("value is not null and not isnan(value)")
    edges = _quantiles(values.where(~F.col(reference)), "value", DECILES, ["feature"], exact).selectExpr(
        "feature", "array_distinct(quantiles) as edges")
    # edges left after removing repeats may be fewer than 11; a missing one counts nothing
    index = " + ".join(f"coalesce(int(value >= get(edges, {i})), 0)" for i in range(1, 11))
    counts = (
        values.join(F.broadcast(edges), "feature")  # one row per compared column
        .where("size(edges) > 1 and value >= edges[0] and value <= element_at(edges, -1)")
        .selectExpr("feature", "size(edges) - 1 as bins", reference, f"least({index}, size(edges) - 2) as bin")
        .groupBy("feature", "bins")
        .agg(bin_counts(10, "e", reference), bin_counts(10, "a", f"not {reference}"))
    )
    share = "transform(slice({0}, 1, bins), k -> (k + 1D) / (aggregate(slice({0}, 1, bins), 0L, (s, x) -> s + x) + bins))"
    psi = counts.selectExpr("feature", f"{share.format('e')} as e", f"{share.format('a')} as a").selectExpr(
        "feature", PSI_SUM.format(e="e", a="a") + " as psi")
    names = F.array(*(F.lit(c) for c in columns))
    return df.sparkSession.range(1).select(F.explode(names).alias("feature")).join(psi, "feature", "left").na.fill(0.0, ["psi"])


def psi_by_group(
    df: DataFrame, value: str, baseline: DataFrame, by: Sequence[str], exact: bool = True
) -> DataFrame:
    """(by, psi) of every group against one baseline column of the same name.

    Edges and baseline shares are a scalar; each group is one aggregate row.
    """
    base = baseline.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias(value))
    edges = _quantiles(base, value, DECILES, [], exact).select("quantiles").scalar()
    binned = base.withColumn("edges", edges).selectExpr(f"{_bin_index(f'`{value}`', 'edges', 11)} as bin")
    expected = binned.agg(bin_counts(10, "c")).selectExpr(f"{_shares('c')} as shares").scalar()
    groups = [f"`{c}`" for c in by]
    return (
        df.where(F.col(value).isNotNull()).withColumn("edges", edges)
        .selectExpr(*groups, f"{_bin_index(f'`{value}`', 'edges', 11)} as bin")
        .groupBy(*by).agg(bin_counts(10, "c"))
        .withColumn("e", expected)
        .selectExpr(*groups, PSI_SUM.format(e="e", a=_shares("c")) + " as psi")
    )


def numeric_moments(df: DataFrame, columns: Sequence[str], reference: str) -> DataFrame:
    """(feature, dev_mean, dev_std, oot_mean, oot_std) with population deviations."""
    side = lambda is_ref: F.when(F.col(reference) == is_ref, F.col("value"))
    return long_form(df, columns, [reference]).groupBy("feature").agg(
        F.avg(side(True)).alias("dev_mean"), F.stddev_pop(side(True)).alias("dev_std"),
        F.avg(side(False)).alias("oot_mean"), F.stddev_pop(side(False)).alias("oot_std"))


# ---- report ---------------------------------------------------------------------
def drift_report(
    df: DataFrame, reference: str, categories: Sequence[str], numbers: Sequence[str], label: str | None = None,
    exact: bool = True,
) -> DataFrame:
    """(feature, drift_type, psi, is_significant, is_critical): one job per kind of column."""
    levels = [*categories, *([label] if label else [])]
    parts = []
    if levels:
        kind = F.when(F.col("feature") == label, "label") if label else F.when(F.lit(False), "")
        parts.append(category_psi(df, levels, reference).select(
            "feature", kind.otherwise("category").alias("drift_type"), "psi"))
    if numbers:
        parts.append(numeric_psi(df, numbers, reference, exact).select("feature", F.lit("numeric").alias("drift_type"), "psi"))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return with_flags(rows)


def drift_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count("*").alias("total_features_checked"),
        F.coalesce(F.sum(flag(F.col("is_significant"))), F.lit(0)).alias("significant_drift_count"),
        F.coalesce(F.sum(flag(F.col("is_critical"))), F.lit(0)).alias("critical_drift_count"))


# ---- profiles -------------------------------------------------------------------
def number_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, count, mean, std, min, max) with the sample deviation; zeros stay zeros."""
    return long_form(df, columns, []).groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))


def level_statistics(df: DataFrame, columns: Sequence[str], top: int = 5) -> DataFrame:
    """(feature, unique_count, rank, value, n) of the most frequent values, ties by value.

    Each map task keeps its ``top`` candidates per column; no task ranks all values.
    """
    counts = long_form(df, columns, [], "string").groupBy("feature", "value").agg(F.count("*").alias("n"))
    uniques = counts.groupBy("feature").agg(F.count("*").alias("unique_count"))
    ranked = counts.withColumn("rank", F.row_number().over(
        W.partitionBy("feature").orderBy(F.desc("n"), F.asc_nulls_first("value")))).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(uniques), "feature").select("feature", "unique_count", "rank", "value", "n")


def score_distribution(df: DataFrame, score: str, by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """(by, n, n_nan, mean, std, median, min, max, q25, q75) with the population deviation; NaN scores are only counted."""
    nan = F.isnan(F.col(score).cast("double"))
    number = F.when(~nan, F.col(score))
    moments = df.groupBy(*by).agg(
        F.count(number).alias("n"), F.count_if(nan).alias("n_nan"), F.avg(number).alias("mean"), F.stddev_pop(number).alias("std"),
        F.min(number).alias("min"), F.max(number).alias("max"))
    points = _quantiles(df, score, [0.25, 0.5, 0.75], by, exact).selectExpr(
        *(f"`{c}`" for c in by), "quantiles[0] as q25", "quantiles[1] as median", "quantiles[2] as q75")
    return attach(moments, points, by)


def attach(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join of two tables with one row per group, null groups included; one row each without groups."""
    if not by:
        one = right.select(F.struct(*right.columns).alias("s")).scalar()
        return left.withColumns({c: one[c] for c in right.columns})
    renamed = right.select(F.struct(*by).alias("_k"), *(c for c in right.columns if c not in by))
    return left.withColumn("_k", F.struct(*by)).join(renamed, "_k", "left").drop("_k")


def zone_mix(df: DataFrame, score: str, lower: float, upper: float, by: Sequence[str] = ()) -> DataFrame:
    """(by, total, zone_<name>_count, zone_<name>_ratio) for high, manual and low."""
    zone = score_zone(F.col(score), lower, upper)
    counted = df.where(F.col(score).isNotNull()).groupBy(*by).agg(F.count("*").alias("total"), *(
        F.count_if(zone == code).alias(f"zone_{name}_count") for name, code in (("high", 2), ("manual", 1), ("low", 0))))
    return counted.withColumns({
        f"zone_{z}_ratio": ratio(F.col(f"zone_{z}_count"), F.col("total")) for z in ("high", "manual", "low")})


def zone_shift(
    df: DataFrame, score: str, baseline: DataFrame, lower: float, upper: float, by: Sequence[str] = (),
    limit: float = 0.10,
) -> DataFrame:
    """Zone mix, its difference from the baseline's mix, and whether the largest one reaches the limit."""
    names = ("high", "manual", "low")
    base = zone_mix(baseline, score, lower, upper)
    mix = base.select(F.struct(*(F.col(f"zone_{z}_ratio").alias(z) for z in names)).alias("m")).scalar()
    shifted = zone_mix(df, score, lower, upper, by).withColumns({f"baseline_zone_{z}_ratio": mix[z] for z in names})
    shifted = shifted.withColumns({
        f"zone_{z}_shift": F.col(f"zone_{z}_ratio") - F.col(f"baseline_zone_{z}_ratio") for z in names})
    return shifted.withColumn("max_shift", F.greatest(*(F.abs(f"zone_{z}_shift") for z in names))).withColumn(
        "shift_warning", F.col("max_shift") >= limit)
