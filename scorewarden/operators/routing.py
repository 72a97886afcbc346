"""Three-zone routing, the threshold grid and the choice of a threshold policy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scorewarden.functions import flag, ratio, score_zone, zone_label


def assign_zones(
    df: DataFrame, score: str, lower, upper, names: Mapping[int, str], zone: str = "pred_zone", label: str = "zone_name"
) -> DataFrame:
    return df.withColumn(zone, score_zone(F.col(score), lower, upper)).withColumn(label, zone_label(F.col(zone), names))


def predictions(
    df: DataFrame, keys: Sequence[str], label: str, score: str, lower: float, upper: float, names: Mapping[int, str],
    source: str,
) -> DataFrame:
    """The stored predictions table: keys, label, score, zone, and the thresholds that produced it."""
    zoned = assign_zones(df, score, lower, upper, names)
    return zoned.select(
        *keys, label, F.col(score).alias("pred_prob"), "pred_zone", "zone_name", F.col(label).alias("actual_label"),
        F.lit(float(lower)).alias("lower_threshold_used"), F.lit(float(upper)).alias("upper_threshold_used"),
        F.lit(source).alias("threshold_source"))


def zone_summary(
    df: DataFrame, label: str, score: str, lower: float, upper: float, names: Mapping[int, str], by: Sequence[str] = ()
) -> DataFrame:
    """One row per group and zone, empty zones included, with the share of correct routing as ``precision``."""
    zone, good = score_zone(F.col(score), lower, upper), F.col(label).cast("double")
    kept = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    stats = kept.groupBy(*by).agg(F.count("*").alias("total"), *(
        F.struct(
            F.lit(z).alias("zone"), F.lit(names[z]).alias("zone_name"), F.count_if(zone == z).alias("count"),
            *(F.coalesce(f(F.when(zone == z, F.col(score))), F.lit(0.0)).alias(n)
              for n, f in (("avg_prob", F.avg), ("min_prob", F.min), ("max_prob", F.max))),
            F.avg(F.when(zone == z, good)).alias("approve"),
        ).alias(f"z{z}") for z in (2, 1, 0)))
    return stats.select(*by, "total", F.inline(F.array("z2", "z1", "z0"))).select(
        *by, "zone", "zone_name", "count", ratio(F.col("count"), F.col("total")).alias("ratio"),
        "avg_prob", "min_prob", "max_prob",
        F.coalesce("approve", F.lit(0.0)).alias("actual_approve_rate"),
        F.coalesce(1 - F.col("approve"), F.lit(0.0)).alias("actual_reject_rate"),
        F.when(F.col("zone") == 2, F.col("approve")).when(F.col("zone") == 0, 1 - F.col("approve")).alias("precision"))


def zone_outcomes(df: DataFrame, label: str, zone: str, by: Sequence[str] = ()) -> DataFrame:
    """Approved and rejected percentage per zone."""
    rate = F.avg(F.col(label).cast("double"))
    return df.where(F.col(label).isNotNull()).groupBy(*by, zone).agg(
        (rate * 100).alias("approve_pct"), ((1 - rate) * 100).alias("reject_pct"))


def routing_kpis_from_zones(df: DataFrame, label: str, zone: str, by: Sequence[str] = (), count: str | None = None) -> DataFrame:
    """Zone ratios, precisions and workload of a table that already has zones; ``count`` names the number of rows that each stands for."""
    z, good, n = F.col(zone), F.col(label).cast("double"), (F.lit(1) if count is None else F.col(count)).cast("long")
    rows = lambda test: F.coalesce(F.sum(F.when(test, n)), F.lit(0))
    mean = lambda code, v: F.try_divide(F.sum(F.when(z == code, v * n)), rows((z == code) & v.isNotNull()))
    counts = df.groupBy(*by).agg(
        rows(F.lit(True)).alias("n"), *(rows(z == code).alias(f"_{code}") for code in (0, 1, 2)),
        mean(2, good).alias("_hp"), mean(0, 1 - good).alias("_lp"))
    high, manual, low = (ratio(F.col(f"_{code}"), F.col("n")) for code in (2, 1, 0))
    return counts.select(
        *by, "n",
        high.alias("high_zone_ratio"), manual.alias("manual_zone_ratio"), low.alias("low_zone_ratio"),
        manual.alias("manual_review_ratio"),
        F.coalesce("_hp", F.lit(0.0)).alias("high_zone_approve_precision"),
        F.coalesce("_lp", F.lit(0.0)).alias("low_zone_reject_precision"),
        (manual + low).alias("human_review_workload_ratio"), high.alias("auto_light_touch_ratio"),
        (high + low).alias("auto_decision_rate"))


def routing_kpis(
    df: DataFrame, label: str, score: str, lower, upper, by: Sequence[str] = (), count: str | None = None
) -> DataFrame:
    kept = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    return routing_kpis_from_zones(kept.withColumn("_zone", score_zone(F.col(score), lower, upper)), label, "_zone", by, count)


def grid_pairs(lowers: Sequence[float], uppers: Sequence[float], min_gap: float | None = None) -> list[tuple[float, float]]:
    """Pairs with lower < upper, or at least ``min_gap`` apart."""
    return [(a, b) for a in lowers for b in uppers if (b - a >= min_gap if min_gap is not None else a < b)]


def threshold_grid(
    df: DataFrame, label: str, score: str, lowers: Sequence[float], uppers: Sequence[float], by: Sequence[str] = (),
    min_gap: float | None = None, count: str | None = None,
) -> DataFrame:
    """All zone figures for every threshold pair, from one pass whose cost ignores the grid.

    Scores are counted between neighbouring thresholds first; a pair's zones are
    sums of those few counts. ``count`` names the number of rows that each stands for.
    """
    cuts = sorted({*lowers, *uppers})
    step = " + ".join(f"int(`{score}` >= {c}D)" for c in cuts)
    cells = (
        df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .selectExpr(*(f"`{c}`" for c in by), f"double(`{label}`) as y", f"`{score}` as s", f"{step} as place", "1L as _n" if count is None else f"`{count}` as _n")
        .groupBy(*by, "place")
        .agg(F.sum("_n").alias("n"), F.sum(F.col("y") * F.col("_n")).alias("good"), F.sum(F.col("s") * F.col("_n")).alias("score"))
    )
    pairs = ", ".join(
        f"struct({a}D as lower_threshold, {b}D as upper_threshold, {cuts.index(a)} as lo, {cuts.index(b)} as hi)"
        for a, b in grid_pairs(lowers, uppers, min_gap))
    keys = [*by, "lower_threshold", "upper_threshold"]
    zones = {"high": "place > hi", "review": "place > lo and place <= hi", "low": "place <= lo"}
    sums = cells.selectExpr(*(f"`{c}`" for c in by), "n", "good", "score", "place", f"inline(array({pairs}))").groupBy(*keys).agg(
        F.sum("n").alias("n"),
        *(F.expr(f"coalesce(sum({v}) filter (where {test}), 0) as {z}_{v}")
          for z, test in zones.items() for v in ("n", "good", "score")))
    share = lambda z: ratio(F.col(f"{z}_n"), F.col("n"))
    mean = lambda z, v: ratio(F.col(f"{z}_{v}"), F.col(f"{z}_n"))
    reject = F.when(F.col("low_n") > 0, 1 - mean("low", "good")).otherwise(0.0)
    return sums.select(
        *keys,
        F.col("high_n").alias("high_zone_count"), share("high").alias("high_zone_ratio"),
        mean("high", "score").alias("high_zone_avg_prob"), mean("high", "good").alias("high_zone_actual_approve_rate"),
        F.col("review_n").alias("review_zone_count"), share("review").alias("review_zone_ratio"),
        mean("review", "score").alias("review_zone_avg_prob"), mean("review", "good").alias("review_zone_actual_approve_rate"),
        F.col("low_n").alias("low_zone_count"), share("low").alias("low_zone_ratio"),
        mean("low", "score").alias("low_zone_avg_prob"), reject.alias("low_zone_actual_reject_rate"),
        ratio(F.col("high_n") + F.col("low_n"), F.col("n")).alias("auto_decision_rate"),
        share("review").alias("manual_review_load"),
        mean("high", "good").alias("expected_precision_high"), reject.alias("expected_precision_low"))


def score_policies(grid: DataFrame, policy: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Adds the hard limits broken, the score, and the rank: passing pairs first, then score, then grid order."""
    auto, manual, low = F.col("auto_decision_rate"), F.col("manual_review_load"), F.col("low_zone_ratio")
    high_precision, low_precision = F.col("expected_precision_high"), F.col("expected_precision_low")

    def broken(name: str, value: Column, sign: str, limit: float) -> Column:
        test = value > limit if sign == ">" else value < limit
        return F.when(test, F.format_string(f"{name}=%.4f {sign} {limit}", value))

    violations = F.array_compact(F.array(
        broken("manual_review", manual, ">", policy["max_manual"]),
        broken("auto_decision_rate", auto, "<", policy["min_auto"]),
        broken("low_zone_ratio", low, "<", policy["min_low"])))
    balance = F.greatest(F.lit(0.0), 1 - F.abs(auto - policy["target_auto"]) * 2) + flag(
        low >= policy["min_low"]) * policy["low_bonus"]
    score = (
        policy["w_precision"] * (high_precision + low_precision) / 2 + policy["w_auto"] * auto
        + policy["w_balance"] * balance
        + (flag(high_precision >= policy["precision_high"]) + flag(low_precision >= policy["precision_low"]))
        * policy["precision_bonus"])
    order = W.partitionBy(*by).orderBy(  # one row per threshold pair
        F.desc("passes_hard_constraints"), F.desc("threshold_score"), "lower_threshold", "upper_threshold")
    return (
        grid.withColumn("constraint_violations", violations)
        .withColumn("passes_hard_constraints", F.size("constraint_violations") == 0)
        .withColumn("threshold_score", score)
        .withColumn("policy_rank", F.row_number().over(order))
    )


def choose_policy(
    scored: DataFrame, default_lower: float, default_upper: float, by: Sequence[str] = ()
) -> DataFrame:
    """The best passing pair, else the best pair; the defaults when there is none. One row per group."""
    best = scored.where(F.col("policy_rank") == 1).select(
        *by, "lower_threshold", "upper_threshold", "threshold_score", "passes_hard_constraints",
        "high_zone_ratio", "review_zone_ratio", "low_zone_ratio", "auto_decision_rate", "manual_review_load",
        "expected_precision_high", "expected_precision_low",
        F.lit("recommended").alias("threshold_source"))
    if by:
        return best
    # one row at most, so it is a scalar; it is null when no pair was scored
    top = best.select(F.struct(*best.columns).alias("top")).scalar()
    row = scored.sparkSession.range(1).select(*(top[c].alias(c) for c in best.columns))
    return row.withColumns({
        "lower_threshold": F.coalesce("lower_threshold", F.lit(default_lower)),
        "upper_threshold": F.coalesce("upper_threshold", F.lit(default_upper)),
        "threshold_source": F.coalesce("threshold_source", F.lit("default")),
        "passes_hard_constraints": F.coalesce("passes_hard_constraints", F.lit(False)),
    })
