"""Zones, the threshold grid and policies."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import LOWER, MODEL_SCORES, R, SCORED, UPPER, model_scores, query, scored, tidy, with_
from scorewarden import vocabulary as v
from scorewarden.functions import score_zone
from scorewarden.operators import routing

_ZONE = "CASE WHEN {s} < 0.5e0 THEN 0 WHEN {s} >= 0.85e0 THEN 2 ELSE 1 END"
_NAME = "CASE {z} WHEN 2 THEN '高通過機率區' WHEN 1 THEN '人工審核區' ELSE '低通過機率區' END"


def _summary(source: str, score: str, by: str) -> str:
    lead = f"{by}, " if by else ""
    return f"""zoned AS (SELECT *, {_ZONE.format(s=score)} AS zone FROM {source}),
keys AS (SELECT * FROM (SELECT {lead}COUNT(*) AS total FROM {source} {f'GROUP BY {by}' if by else ''}), (VALUES (0), (1), (2)) z(zone)),
summary AS (SELECT {'k.' + by + ',' if by else ''} k.zone, {_NAME.format(z='k.zone')} AS zone_name, COUNT(z.label) AS count,
  {R(f"COUNT(z.label) / CAST(MAX(total) AS DOUBLE)")} AS ratio, {R(f"COALESCE(AVG({score}), 0)")} AS avg_prob, {R(f"COALESCE(MIN({score}), 0)")} AS min_prob,
  {R(f"COALESCE(MAX({score}), 0)")} AS max_prob, {R("COALESCE(AVG(label), 0)")} AS actual_approve_rate, {R("COALESCE(1 - AVG(label), 0)")} AS actual_reject_rate,
  {R("CASE k.zone WHEN 2 THEN AVG(label) WHEN 0 THEN 1 - AVG(label) END")} AS precision
  FROM keys k LEFT JOIN zoned z ON k.zone = z.zone {f'AND k.{by} = z.{by}' if by else ''} GROUP BY {f'k.{by}, ' if by else ''}k.zone)"""


@query("zone_summary", with_(SCORED, _summary("scored", "score", ""), select="SELECT * FROM summary"))
def zone_summary(spark, folder):
    return tidy(routing.zone_summary(scored(spark, folder), "label", "score", LOWER, UPPER, v.ZONE_NAMES))


@query("zone_summary_by_model", with_(SCORED, MODEL_SCORES, _summary("model_scores", "p", "model"), select="SELECT * FROM summary"))
def zone_summary_by_model(spark, folder):
    return tidy(routing.zone_summary(model_scores(spark, folder), "label", "p", LOWER, UPPER, v.ZONE_NAMES, ["model"]))


@query("predictions", with_(SCORED, select=f"""SELECT l_orderkey, l_linenumber, l_partkey, label, {R('score')} AS pred_prob, {_ZONE.format(s='score')} AS pred_zone,
  {_NAME.format(z=_ZONE.format(s='score'))} AS zone_name, label AS actual_label, 0.5e0 AS lower_threshold_used, 0.85e0 AS upper_threshold_used,
  'recommended' AS threshold_source FROM scored"""))
def predictions(spark, folder):
    return tidy(routing.predictions(scored(spark, folder), ["l_orderkey", "l_linenumber", "l_partkey"], "label", "score", LOWER, UPPER, v.ZONE_NAMES, "recommended"))


@query("zone_outcomes", with_(SCORED, select=f"SELECT {_ZONE.format(s='score')} AS zone, {R('AVG(label) * 100')} AS approve_pct, {R('100 - AVG(label) * 100')} AS reject_pct FROM scored GROUP BY 1"))
def zone_outcomes(spark, folder):
    return tidy(routing.zone_outcomes(scored(spark, folder).withColumn("zone", score_zone(F.col("score"), LOWER, UPPER)), "label", "zone"))


def kpis_sql(by: str, score: str, source: str, label: str = "label") -> str:
    z = _ZONE.format(s=score)
    r = {n: f"(COUNT(*) FILTER (WHERE {z} = {c}) / CAST(COUNT(*) AS DOUBLE))" for n, c in (("h", 2), ("m", 1), ("l", 0))}
    return f"""SELECT {by}, COUNT(*) AS n, {R(r['h'])} AS high_zone_ratio, {R(r['m'])} AS manual_zone_ratio, {R(r['l'])} AS low_zone_ratio,
      {R(r['m'])} AS manual_review_ratio, {R(f"COALESCE(AVG({label}) FILTER (WHERE {z} = 2), 0)")} AS high_zone_approve_precision,
      {R(f"COALESCE(1 - AVG({label}) FILTER (WHERE {z} = 0), 0)")} AS low_zone_reject_precision, {R(f"{r['m']} + {r['l']}")} AS human_review_workload_ratio,
      {R(r['h'])} AS auto_light_touch_ratio, {R(f"{r['h']} + {r['l']}")} AS auto_decision_rate FROM {source} WHERE {label} IS NOT NULL GROUP BY {by}"""


@query("routing_kpis", with_(SCORED, MODEL_SCORES, select=kpis_sql("model", "p", "model_scores")))
def routing_kpis(spark, folder):
    return tidy(routing.routing_kpis(model_scores(spark, folder), "label", "p", LOWER, UPPER, ["model"]))


@query("routing_kpis_by_segment", with_(SCORED, select=kpis_sql("segment", "coarse", "scored", "late_label")))
def routing_kpis_by_segment(spark, folder):
    return tidy(routing.routing_kpis(scored(spark, folder), "late_label", "coarse", LOWER, UPPER, ["segment"]))


def _pairs(gap: bool) -> str:
    keep = routing.grid_pairs(v.LOWER_GRID, v.UPPER_GRID, v.MIN_GRID_GAP if gap else None)
    return "pairs AS (SELECT * FROM (VALUES " + ", ".join(f"({a}e0, {b}e0)" for a, b in keep) + ") p(lo, hi))"


def _grid(source: str, score: str, by: str) -> str:
    lead = f"{by}, " if by else ""
    zones = {"high": f"{score} >= hi", "review": f"{score} >= lo AND {score} < hi", "low": f"{score} < lo"}
    count = {z: f"COUNT(*) FILTER (WHERE {t})" for z, t in zones.items()}
    mean = lambda z, x: f"COALESCE(AVG({x}) FILTER (WHERE {zones[z]}), 0)"
    reject = f"COALESCE(1 - AVG(label) FILTER (WHERE {zones['low']}), 0)"
    return f"""grid AS (SELECT {lead}lo AS lower_threshold, hi AS upper_threshold,
      {', '.join(f"{count[z]} AS {z}_zone_count, {count[z]} / CAST(COUNT(*) AS DOUBLE) AS {z}_zone_ratio, {mean(z, score)} AS {z}_zone_avg_prob" for z in zones)},
      {mean('high', 'label')} AS high_zone_actual_approve_rate, {mean('review', 'label')} AS review_zone_actual_approve_rate, {reject} AS low_zone_actual_reject_rate,
      ({count['high']} + {count['low']}) / CAST(COUNT(*) AS DOUBLE) AS auto_decision_rate, {count['review']} / CAST(COUNT(*) AS DOUBLE) AS manual_review_load,
      {mean('high', 'label')} AS expected_precision_high, {reject} AS expected_precision_low FROM {source}, pairs GROUP BY {lead}lo, hi)"""


_DOUBLES = ["high_zone_ratio", "high_zone_avg_prob", "high_zone_actual_approve_rate", "review_zone_ratio", "review_zone_avg_prob",
            "review_zone_actual_approve_rate", "low_zone_ratio", "low_zone_avg_prob", "low_zone_actual_reject_rate", "auto_decision_rate",
            "manual_review_load", "expected_precision_high", "expected_precision_low"]
_COUNTS = ["high_zone_count", "review_zone_count", "low_zone_count"]


def _grid_select(by: str) -> str:
    lead = f"{by}, " if by else ""
    return f"SELECT {lead}lower_threshold, upper_threshold, {', '.join(_COUNTS)}, {', '.join(f'{R(c)} AS {c}' for c in _DOUBLES)} FROM grid"


@query("threshold_grid", with_(SCORED, MODEL_SCORES, _pairs(False), _grid("model_scores", "p", "model"), select=_grid_select("model")))
def threshold_grid(spark, folder):
    return tidy(routing.threshold_grid(model_scores(spark, folder), "label", "p", v.LOWER_GRID, v.UPPER_GRID, ["model"]))


@query("threshold_grid_with_gap", with_(SCORED, _pairs(True), _grid("scored", "coarse", ""), select=_grid_select("")))
def threshold_grid_with_gap(spark, folder):
    return tidy(routing.threshold_grid(scored(spark, folder), "label", "coarse", v.LOWER_GRID, v.UPPER_GRID, min_gap=v.MIN_GRID_GAP))


POLICIES = """policies AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY passes_hard_constraints DESC, ROUND(threshold_score, 12) DESC, lower_threshold, upper_threshold) AS policy_rank FROM (
  SELECT *, manual_review_load <= 0.15e0 AND auto_decision_rate >= 0.85e0 AND low_zone_ratio >= 0.02e0 AS passes_hard_constraints,
    CASE WHEN manual_review_load > 0.15e0 THEN 1 ELSE 0 END + CASE WHEN auto_decision_rate < 0.85e0 THEN 1 ELSE 0 END + CASE WHEN low_zone_ratio < 0.02e0 THEN 1 ELSE 0 END AS violations,
    0.40e0 * (expected_precision_high + expected_precision_low) / 2 + 0.35e0 * auto_decision_rate
      + 0.25e0 * (GREATEST(0, 1 - 2 * ABS(auto_decision_rate - 0.90e0)) + CASE WHEN low_zone_ratio >= 0.02e0 THEN 0.1e0 ELSE 0 END)
      + CASE WHEN expected_precision_high >= 0.95e0 THEN 0.05e0 ELSE 0 END + CASE WHEN expected_precision_low >= 0.70e0 THEN 0.05e0 ELSE 0 END AS threshold_score FROM grid))"""
GRID_BY_MODEL = (SCORED, MODEL_SCORES, _pairs(False), _grid("model_scores", "p", "model"), POLICIES)


@query("threshold_policies", with_(*GRID_BY_MODEL, select=f"""SELECT model, lower_threshold, upper_threshold, passes_hard_constraints, violations,
  {R('threshold_score')} AS threshold_score FROM policies"""))
def threshold_policies(spark, folder):
    grid = routing.threshold_grid(model_scores(spark, folder), "label", "p", v.LOWER_GRID, v.UPPER_GRID, ["model"])
    return tidy(routing.score_policies(grid, v.POLICY, ["model"]).select(
        "model", "lower_threshold", "upper_threshold", "passes_hard_constraints", F.size("constraint_violations").alias("violations"), "threshold_score"))


@query("chosen_policy", with_(*GRID_BY_MODEL, select=f"""SELECT model, lower_threshold, upper_threshold, {R('threshold_score')} AS threshold_score, passes_hard_constraints,
  {R('auto_decision_rate')} AS auto_decision_rate, 'recommended' AS threshold_source FROM policies WHERE policy_rank = 1"""))
def chosen_policy(spark, folder):
    grid = routing.threshold_grid(model_scores(spark, folder), "label", "p", v.LOWER_GRID, v.UPPER_GRID, ["model"])
    best = routing.choose_policy(routing.score_policies(grid, v.POLICY, ["model"]), LOWER, UPPER, ["model"])
    return tidy(best.select("model", "lower_threshold", "upper_threshold", "threshold_score", "passes_hard_constraints", "auto_decision_rate", "threshold_source"))
