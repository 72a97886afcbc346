"""Champion ranking, gaps, candidate scores, comparisons and upgrade decisions of three scored models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.base import (
    CUT, DATA_START, LOWER, MODEL_SCORES, R, SCORED, UPPER, WINDOWS, metric_ctes, model_scores, query, scored, tidy, with_,
)
from catalog.metrics import TAGGED_SQL
from scorewarden import vocabulary as v
from scorewarden.operators import metrics, routing, selection
from scorewarden.operators.splits import month_folds, rolling_windows, tag_windows
from scorewarden.plans.challengers import LOWER_IS_BETTER, METRIC_COLUMNS
from scorewarden.plans.training import LEGACY_SPREAD, SPREAD
from scorewarden.storage import settled

_MONITOR = {"auc": "auc", "f1": "f1", "f1_reject": "f1_reject", "precision": "precision", "recall": "recall", "ks": "ks", "brier": "brier_score"}

FOLD_SQL = """months AS (SELECT *, DENSE_RANK() OVER (PARTITION BY window_id ORDER BY month) AS m FROM (
  SELECT DISTINCT window_id, strftime(day, '%Y-%m') AS month FROM tagged WHERE phase = 'train')),
fold_rows AS (SELECT t.*, m - 2 AS fold FROM tagged t JOIN months USING (window_id) WHERE phase = 'train' AND strftime(day, '%Y-%m') = month AND m IN (3, 4))"""
CYCLES = [
    SCORED, MODEL_SCORES, WINDOWS, TAGGED_SQL, *metric_ctes("tagged", ["window_id", "phase", "model"], "label", "p"),
    FOLD_SQL, *metric_ctes("fold_rows", ["window_id", "model", "fold"], "label", "p", "cvm"),
    "cv AS (SELECT window_id, model, " + ", ".join(
        f"{f}({m}) AS cv_{m}_{s}" for m in ("auc", "f1", "f1_reject") for f, s in (("AVG", "mean"), ("STDDEV_POP", "std"))) + " FROM cvm GROUP BY 1, 2)",
    "cycles AS (SELECT a.window_id, a.model AS model_name, t.auc AS train_auc, t.brier_score AS train_brier, a.rows AS monitor_rows, "
    + ", ".join(f"a.{m} AS monitor_{n}" for n, m in _MONITOR.items()) + ", cv.* EXCLUDE (window_id, model) FROM metrics a JOIN metrics t"
    " ON a.window_id = t.window_id AND a.model = t.model AND a.phase = 'monitor' AND t.phase = 'train' LEFT JOIN cv ON cv.window_id = a.window_id AND cv.model = a.model)",
]


def _figures(spark, folder, *others):
    """Metrics of the three scores per window and phase, cv folds included; ``others`` are further groups of days, with columns as here.

    Every group is one of days: rows are counted per day's groups before they are unfolded.
    """
    days = settled(scored(spark, folder).select("day").distinct())
    tagged = tag_windows(days, rolling_windows(spark, DATA_START, CUT), "day")
    folded = month_folds(tagged.where("phase = 'train'"), "day", ["window_id"]).where("role = 'validate'")
    columns = ["day", "window_id", "phase", "fold"]
    groups = tagged.withColumn("fold", F.lit(0)).select(*columns).unionByName(folded.withColumn("phase", F.lit("cv")).select(*columns))
    for other in others:
        groups = groups.unionByName(other(days).select(*columns))
    return settled(metrics.overlapping_metrics(model_scores(spark, folder), "label", "p", groups, "day", ["model"]))


def cycles(spark, folder):
    """Rolling results of the three scores: train, monitor and walk-forward validation figures."""
    return _cycles(_figures(spark, folder))


def _cycles(both):
    pair = ["window_id", "model"]
    cv = both.where("phase = 'cv'").groupBy(*pair).agg(
        *(f(m).alias(f"cv_{m}_{s}") for m in ("auc", "f1", "f1_reject") for f, s in ((F.avg, "mean"), (F.stddev_pop, "std"))))
    monitor = both.where("phase = 'monitor'").select(*pair, F.col("rows").alias("monitor_rows"), *(F.col(m).alias(f"monitor_{n}") for n, m in _MONITOR.items()))
    train = both.where("phase = 'train'").select(*pair, F.col("auc").alias("train_auc"), F.col("brier_score").alias("train_brier"))
    return monitor.join(train, pair).join(cv, pair, "left").withColumnRenamed("model", "model_name")


_CYCLE_DOUBLES = ["train_auc", "train_brier", *(f"monitor_{n}" for n in _MONITOR), *(f"cv_{m}_{s}" for m in ("auc", "f1", "f1_reject") for s in ("mean", "std"))]


@query("rolling_cycles", with_(*CYCLES, select="SELECT window_id, model_name, monitor_rows, " + ", ".join(f"{R(c)} AS {c}" for c in _CYCLE_DOUBLES) + " FROM cycles"))
def rolling_cycles(spark, folder):
    return tidy(cycles(spark, folder))


def _champion_sql(weights: dict, spread: list[str]) -> str:
    source = {"cv_auc": "cv_auc_mean", "cv_f1_reject": "cv_f1_reject_mean", "monitor_auc": "monitor_auc", "monitor_f1": "monitor_f1",
              "monitor_f1_reject": "monitor_f1_reject", "monitor_ks": "monitor_ks", "monitor_brier": "monitor_brier"}
    stats = ", ".join(f"AVG({c}) AS avg_{m}, STDDEV_POP({c}) AS std_{m}" for m, c in source.items())
    score = " + ".join(f"avg_{m} * {w}e0" for m, w in weights.items() if m != "stability" and w)
    doubles = [f"{a}_{m}" for m in source for a in ("avg", "std")] + ["stability_score", "overall_score"]
    return with_(*CYCLES, f"stats AS (SELECT model_name, COUNT(*) AS cycles, {stats} FROM cycles GROUP BY 1)",
                 f"stable AS (SELECT *, ({' + '.join('std_' + m for m in spread)}) / {len(spread)} AS stability_score FROM stats)",
                 f"final AS (SELECT *, {score} - stability_score * {weights['stability']}e0 AS overall_score FROM stable)",
                 select=f"SELECT model_name, cycles, {', '.join(f'{R(d)} AS {d}' for d in doubles)}, CAST(ROW_NUMBER() OVER (ORDER BY overall_score DESC) AS INTEGER) AS model_rank FROM final")


@query("champion_ranking", _champion_sql(v.CHAMPION_WEIGHTS, SPREAD))
def champion_ranking(spark, folder):
    return tidy(selection.rank_champions(cycles(spark, folder), v.CHAMPION_WEIGHTS, SPREAD).drop("ranking_reason"))


@query("legacy_champion_ranking", _champion_sql(v.LEGACY_CHAMPION_WEIGHTS, LEGACY_SPREAD))
def legacy_champion_ranking(spark, folder):
    return tidy(selection.rank_champions(cycles(spark, folder), v.LEGACY_CHAMPION_WEIGHTS, LEGACY_SPREAD).drop("ranking_reason"))


@query("rolling_stability", with_(*CYCLES, select=f"""SELECT model_name, {R('AVG(monitor_auc)')} AS avg_monitor_auc, {R('AVG(monitor_f1_reject)')} AS avg_monitor_f1_reject,
  {R('AVG(monitor_ks)')} AS avg_monitor_ks, {R('AVG(monitor_brier)')} AS avg_monitor_brier, {R('STDDEV_SAMP(monitor_auc)')} AS std_monitor_auc,
  {R('STDDEV_SAMP(monitor_auc)')} AS stability_score FROM cycles WHERE model_name = 'boosted' GROUP BY 1"""))
def rolling_stability(spark, folder):
    return tidy(selection.rolling_stability(cycles(spark, folder)))


# ---- stages: train, policy, holdout ---------------------------------------------------
_P, _H = dt.date(1999, 6, 1), dt.date(2000, 9, 1)
STAGED_SQL = """staged AS (SELECT *, CASE WHEN day < DATE '1999-06-01' THEN 'train' WHEN day < DATE '2000-09-01' THEN 'policy' ELSE 'holdout' END AS stage FROM model_scores)"""


def _stage():
    return F.when(F.col("day") < F.lit(_P), "train").when(F.col("day") < F.lit(_H), "policy").otherwise("holdout")


_ZONE = "CASE WHEN p < 0.5e0 THEN 0 WHEN p >= 0.85e0 THEN 2 ELSE 1 END"
CANDIDATES = [*CYCLES, STAGED_SQL, *metric_ctes("staged", ["model", "stage"], "label", "p", "sm"),
  f"""zones AS (SELECT model, AVG(CASE WHEN zone = 2 THEN 1 ELSE 0 END) AS high_zone_ratio, AVG(CASE WHEN zone = 1 THEN 1 ELSE 0 END) AS manual_review_ratio,
    AVG(CASE WHEN zone = 0 THEN 1 ELSE 0 END) AS low_zone_ratio, COALESCE(AVG(label) FILTER (WHERE zone = 2), 0) AS high_zone_approve_precision,
    COALESCE(1 - AVG(label) FILTER (WHERE zone = 0), 0) AS low_zone_reject_precision, AVG(CASE WHEN zone <> 2 THEN 1 ELSE 0 END) AS human_review_workload_ratio,
    AVG(CASE WHEN zone <> 1 THEN 1 ELSE 0 END) AS auto_decision_rate FROM (SELECT *, {_ZONE} AS zone FROM staged WHERE stage = 'holdout') GROUP BY 1)""",
  """rolled AS (SELECT model_name AS model, AVG(train_auc) AS avg_train_auc, AVG(monitor_auc) AS avg_monitor_auc, AVG(monitor_f1_reject) AS avg_monitor_f1_reject,
    AVG(monitor_ks) AS avg_monitor_ks, AVG(monitor_brier) AS avg_monitor_brier, STDDEV_POP(monitor_auc) AS stability_score,
    (STDDEV_POP(monitor_auc) + STDDEV_POP(monitor_f1_reject) + STDDEV_POP(monitor_ks)) / 3 AS spread FROM cycles GROUP BY 1)""",
  """candidates AS (SELECT r.*, z.* EXCLUDE (model), h.auc AS holdout_auc, h.f1_reject AS holdout_f1_reject, h.brier_score AS holdout_brier, h.ks AS holdout_ks,
    h.precision_reject, h.recall_reject, t.auc AS train_auc, t.f1_reject AS train_f1_reject, t.brier_score AS train_brier, q.auc AS policy_auc
    FROM rolled r JOIN zones z USING (model) JOIN sm h ON h.model = r.model AND h.stage = 'holdout'
    JOIN sm t ON t.model = r.model AND t.stage = 'train' JOIN sm q ON q.model = r.model AND q.stage = 'policy')"""]


def candidates(spark, folder):
    """One row per model with everything the selection operators ask for."""
    # the stages are groups of days like the windows, of fold -1
    figures = _figures(spark, folder, lambda days: days.select("day", F.lit(None).cast("int").alias("window_id"), _stage().alias("phase"), F.lit(-1).alias("fold")))
    stage = figures.where("fold = -1").withColumnRenamed("phase", "stage")
    at = lambda s, m: F.max(F.when(F.col("stage") == s, F.col(m)))
    wide = stage.groupBy("model").agg(
        at("holdout", "auc").alias("holdout_auc"), at("holdout", "f1_reject").alias("holdout_f1_reject"),
        at("holdout", "brier_score").alias("holdout_brier"), at("holdout", "ks").alias("holdout_ks"),
        at("holdout", "precision_reject").alias("precision_reject"), at("holdout", "recall_reject").alias("recall_reject"),
        at("train", "auc").alias("train_auc"), at("train", "f1_reject").alias("train_f1_reject"), at("train", "brier_score").alias("train_brier"),
        at("policy", "auc").alias("policy_auc"))
    rows = scored(spark, folder).where(_stage() == "holdout")
    zones = routing.routing_kpis(model_scores(spark, folder, rows), "label", "p", LOWER, UPPER, ["model"]).drop("n")
    rolled = _cycles(figures.where("fold >= 0")).groupBy(F.col("model_name").alias("model")).agg(
        F.avg("train_auc").alias("avg_train_auc"), F.avg("monitor_auc").alias("avg_monitor_auc"), F.avg("monitor_f1_reject").alias("avg_monitor_f1_reject"),
        F.avg("monitor_ks").alias("avg_monitor_ks"), F.avg("monitor_brier").alias("avg_monitor_brier"), F.stddev_pop("monitor_auc").alias("stability_score"),
        ((F.stddev_pop("monitor_auc") + F.stddev_pop("monitor_f1_reject") + F.stddev_pop("monitor_ks")) / 3).alias("spread"))
    return settled(rolled.join(zones, "model").join(wide, "model"))


_GAPS = """gaps AS (SELECT model, train_auc - avg_monitor_auc AS a, train_auc - holdout_auc AS b, avg_monitor_auc - holdout_auc AS c,
  CASE WHEN train_brier > 0 AND avg_monitor_brier > 0 THEN avg_monitor_brier - train_brier ELSE 0 END AS d,
  train_brier > 0 AND avg_monitor_brier > 0 AND avg_monitor_brier / train_brier > 2 AS cal, holdout_f1_reject > 0 AND holdout_f1_reject < 0.45e0 AS rej FROM candidates)"""


@query("stage_gaps", with_(*CANDIDATES, _GAPS, select=f"""SELECT model, {R('a')} AS gap_train_vs_monitor_auc, {R('b')} AS gap_train_vs_holdout_auc,
  {R('c')} AS gap_monitor_vs_holdout_auc, {R('d')} AS gap_train_vs_monitor_brier, GREATEST(ABS(a), ABS(b)) >= 0.02e0 AS is_overfitting,
  CASE WHEN GREATEST(ABS(a), ABS(b)) < 0.02e0 THEN 'none' WHEN GREATEST(ABS(a), ABS(b)) < 0.05e0 THEN 'mild' WHEN GREATEST(ABS(a), ABS(b)) < 0.10e0 THEN 'moderate' ELSE 'severe' END AS overfitting_severity,
  cal AS has_calibration_issue, rej AS has_reject_detection_issue FROM gaps"""))
def stage_gaps(spark, folder):
    rows = candidates(spark, folder).withColumnsRenamed({"holdout_auc": "final_holdout_auc", "holdout_f1_reject": "final_holdout_f1_reject"})
    return tidy(selection.stage_gaps(rows).select(
        "model", "gap_train_vs_monitor_auc", "gap_train_vs_holdout_auc", "gap_monitor_vs_holdout_auc", "gap_train_vs_monitor_brier",
        "is_overfitting", "overfitting_severity", "has_calibration_issue", "has_reject_detection_issue"))


@query("tuning_ranking", with_(*CANDIDATES, """tuned AS (SELECT model AS config_id, 0.25e0 * holdout_f1_reject + 0.15e0 * avg_monitor_f1_reject
  + 0.15e0 * (1 - holdout_brier) + 0.10e0 * (1 - avg_monitor_brier) + 0.10e0 * holdout_auc + 0.10e0 * avg_monitor_auc - 0.15e0 * spread AS tuning_score FROM candidates)""",
  select=f"SELECT config_id, {R('tuning_score')} AS tuning_score, CAST(ROW_NUMBER() OVER (ORDER BY tuning_score DESC) AS INTEGER) AS tuning_rank FROM tuned"))
def tuning_ranking(spark, folder):
    rows = candidates(spark, folder).drop("stability_score").withColumnsRenamed({"spread": "stability_score", "model": "config_id"})
    scored = selection.tuning_score(rows.withColumn("calibration_method", F.lit("none")), v.TUNING_WEIGHTS)
    return tidy(scored.select("config_id", "tuning_score", "tuning_rank"))


DECIDED = """decided AS (SELECT *, 0.25e0 * low_zone_reject_precision + 0.15e0 * high_zone_approve_precision + 0.15e0 * (1 - manual_review_ratio) + 0.15e0 * holdout_f1_reject
    + 0.10e0 * (1 - holdout_brier) + 0.10e0 * holdout_auc + 0.10e0 * holdout_ks AS decision_score,
  2 * (GREATEST(avg_train_auc - avg_monitor_auc - 0.03e0, 0) + GREATEST(ABS(avg_monitor_auc - holdout_auc) - 0.04e0, 0) + GREATEST(stability_score - 0.03e0, 0)) AS overfitting_penalty,
  1.5e0 * (GREATEST(avg_monitor_f1_reject - holdout_f1_reject - 0.05e0, 0) + GREATEST(avg_monitor_brier - train_brier - 0.10e0, 0)) AS robustness_penalty,
  high_zone_approve_precision >= 0.98e0 AND manual_review_ratio <= 0.12e0 AND auto_decision_rate >= 0.85e0 AND avg_train_auc - avg_monitor_auc <= 0.08e0 AS passes_hard_constraints FROM candidates)"""


@query("decision_score", with_(*CANDIDATES, DECIDED, select=f"""SELECT model AS config_id, {R('decision_score')} AS decision_score, {R('overfitting_penalty')} AS overfitting_penalty,
  {R('robustness_penalty')} AS robustness_penalty, {R('decision_score - overfitting_penalty - robustness_penalty')} AS final_selection_score, passes_hard_constraints,
  low_zone_reject_precision >= 0.65e0 AS meets_low_zone_target,
  CAST(ROW_NUMBER() OVER (ORDER BY passes_hard_constraints DESC, decision_score - overfitting_penalty - robustness_penalty DESC) AS INTEGER) AS selection_rank FROM decided"""))
def decision_score(spark, folder):
    rows = selection.decision_score(candidates(spark, folder).withColumnRenamed("model", "config_id"), v.DECISION)
    return tidy(rows.select("config_id", "decision_score", "overfitting_penalty", "robustness_penalty", "final_selection_score",
                            "passes_hard_constraints", "meets_low_zone_target", "selection_rank"))


# ---- comparisons with the 'linear' score as baseline -----------------------------------
_RENAMED = {"holdout_auc": "auc", "holdout_f1_reject": "f1_reject", "holdout_brier": "brier_score", "holdout_ks": "ks"}
_BACK = {new: old for old, new in _RENAMED.items()}
_LONG = "long AS (" + " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {_BACK.get(m, m)} AS value FROM candidates" for m in METRIC_COLUMNS) + ")"
_COMPARED = """compared AS (SELECT c.model, metric, b.value AS base_value, c.value AS challenger_value, c.value - b.value AS delta,
  CASE WHEN metric IN ('brier_score', 'manual_review_ratio', 'human_review_workload_ratio') THEN b.value - c.value ELSE c.value - b.value END AS gain
  FROM long c JOIN long b USING (metric) WHERE b.model = 'linear' AND c.model <> 'linear')"""


def _sides(spark, folder):
    rows = candidates(spark, folder).withColumnsRenamed(_RENAMED)
    return rows.where("model = 'linear'"), rows.where("model != 'linear'")


@query("metric_comparison", with_(*CANDIDATES, _LONG, _COMPARED, select=f"""SELECT model, metric, {R('base_value')} AS base_value, {R('challenger_value')} AS challenger_value,
  {R('delta')} AS delta, CASE WHEN gain > 0.001e0 THEN 'IMPROVED' WHEN gain < -0.001e0 THEN 'REGRESSED' ELSE 'UNCHANGED' END AS verdict FROM compared"""))
def metric_comparison(spark, folder):
    base, others = _sides(spark, folder)
    return tidy(selection.compare_metrics(
        selection.long_metrics(base, [], METRIC_COLUMNS), selection.long_metrics(others, ["model"], METRIC_COLUMNS), LOWER_IS_BETTER))


@query("baseline_comparison", with_(*CANDIDATES, _LONG, _COMPARED, select=f"""SELECT metric, {R('base_value')} AS base_value, {R('challenger_value')} AS challenger_value,
  {R('delta')} AS delta, CASE WHEN metric = 'brier_score' THEN delta < 0 ELSE delta > 0 END AS improved FROM compared
  WHERE model = 'boosted' AND metric IN ('auc', 'f1_reject', 'ks', 'brier_score', 'precision_reject', 'recall_reject')"""))
def baseline_comparison(spark, folder):
    base, others = _sides(spark, folder)
    names = ["auc", "f1_reject", "ks", "brier_score", "precision_reject", "recall_reject"]
    return tidy(selection.compare_baselines(
        selection.long_metrics(base, [], names), selection.long_metrics(others.where("model = 'boosted'"), [], names)))


_UPGRADE = [DECIDED, """upgrades AS (SELECT c.model AS challenger, c.low_zone_reject_precision > b.low_zone_reject_precision + 0.005e0 AS precision_improved,
  c.manual_review_ratio + c.low_zone_ratio <= b.manual_review_ratio + b.low_zone_ratio + 0.02e0 AS workload_ok, c.high_zone_approve_precision >= 0.98e0 AS high_zone_ok,
  c.holdout_auc >= b.holdout_auc - 0.01e0 AS auc_ok, c.holdout_f1_reject >= b.holdout_f1_reject - 0.02e0 AS f1_reject_ok, c.overfitting_penalty < 0.03e0 AS overfit_ok
  FROM decided c JOIN decided b ON b.model = 'linear' AND c.model <> 'linear')""",
  """verdicts AS (SELECT *, CASE WHEN NOT (precision_improved AND workload_ok AND high_zone_ok) THEN 'reject' WHEN auc_ok AND f1_reject_ok AND overfit_ok THEN 'full_upgrade'
  ELSE 'routing_only_upgrade' END AS upgrade_candidate FROM upgrades)"""]
_TESTS = ["precision_improved", "workload_ok", "high_zone_ok", "auc_ok", "f1_reject_ok", "overfit_ok"]


def upgrades(found):
    rows = selection.decision_score(found.withColumnRenamed("model", "config_id"), v.DECISION).withColumnsRenamed(_RENAMED)
    base = rows.where("config_id = 'linear'").select(F.struct(*METRIC_COLUMNS).alias("b")).scalar()
    both = rows.where("config_id != 'linear'").withColumnsRenamed({m: f"ch_{m}" for m in METRIC_COLUMNS}).withColumns({f"base_{m}": base[m] for m in METRIC_COLUMNS})
    return selection.upgrade_decision(both, v.UPGRADE).withColumnRenamed("config_id", "challenger")


@query("upgrade_decision", with_(*CANDIDATES, *_UPGRADE, select=f"SELECT challenger, {', '.join(_TESTS)}, upgrade_candidate FROM verdicts"))
def upgrade_decision(spark, folder):
    return upgrades(candidates(spark, folder)).select("challenger", *_TESTS, "upgrade_candidate")


_BEST = """best AS (SELECT * FROM verdicts ORDER BY CASE upgrade_candidate WHEN 'full_upgrade' THEN 3 WHEN 'routing_only_upgrade' THEN 2 ELSE 1 END DESC, challenger LIMIT 1)"""


@query("best_challenger", with_(*CANDIDATES, *_UPGRADE, _BEST, select="""SELECT CASE WHEN upgrade_candidate <> 'reject' THEN challenger END AS best_challenger, upgrade_candidate AS best_status,
  CASE upgrade_candidate WHEN 'full_upgrade' THEN 'FULL_UPGRADE' WHEN 'routing_only_upgrade' THEN 'ROUTING_ONLY_UPGRADE' ELSE 'RETAIN_BASELINE' END AS decision_type FROM best"""))
def best_challenger(spark, folder):
    return selection.best_challenger(upgrades(candidates(spark, folder)))


@query("final_decision", with_(*CANDIDATES, *_UPGRADE, _BEST, select="""SELECT 'linear' AS active_baseline,
  CASE upgrade_candidate WHEN 'full_upgrade' THEN 'FULL_UPGRADE' WHEN 'routing_only_upgrade' THEN 'ROUTING_ONLY_UPGRADE' ELSE 'RETAIN_BASELINE' END AS decision_type,
  CASE WHEN upgrade_candidate <> 'reject' THEN challenger ELSE 'linear' END AS chosen, CASE WHEN upgrade_candidate <> 'reject' THEN 0.6e0 ELSE 0.5e0 END AS lower_threshold,
  0.85e0 AS upper_threshold FROM best"""))
def final_decision(spark, folder):
    found = candidates(spark, folder)
    rows = settled(upgrades(found).select("challenger", "upgrade_candidate", "upgrade_reason").withColumns(
        {"lower_threshold": F.lit(0.6), "upper_threshold": F.lit(UPPER)}))
    base = found.where("model = 'linear'").select(
        F.col("model").alias("name"), F.lit(LOWER).alias("lower_threshold"), F.lit(UPPER).alias("upper_threshold"))
    return selection.resolve_decision(selection.best_challenger(rows), base, rows.drop("upgrade_candidate")).drop("decision_reason")


@query("routing_recommendation", with_(*CANDIDATES, select="""SELECT model, CASE WHEN high_zone_approve_precision >= 0.98e0 THEN 'YES' ELSE 'REVIEW NEEDED' END AS auto_approve,
  CASE WHEN low_zone_reject_precision >= 0.55e0 THEN 'YES' ELSE 'MARGINAL' END AS low_zone_review_pool,
  CASE WHEN low_zone_reject_precision >= 0.65e0 THEN 'YES' ELSE 'NOT RECOMMENDED' END AS auto_reject FROM candidates"""))
def routing_recommendation(spark, folder):
    return selection.recommendation(candidates(spark, folder)).select("model", "auto_approve", "low_zone_review_pool", "auto_reject")
