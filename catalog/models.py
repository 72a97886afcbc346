"""Model fitting and what is built on it, with the SQL of everything in the results that a fit does not decide.

Rows, windows, folds, candidates, calibrations and their parameters are those of the library.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.base import APPLICATIONS, CUT, DATA_START, LOWER, R, SCORED, UPPER, WINDOWS, applications, query, scored, tidy, with_
from scorewarden import vocabulary as v
from scorewarden.functions import level_code
from scorewarden.operators import boosting, learners, metrics, monitoring
from scorewarden.operators.ordering import add_bucket, bucket_edges
from scorewarden.operators.splits import rolling_windows
from scorewarden.plans import challengers, training, watch
from scorewarden.storage import settled

_FEATURES = ["amount", "balance", "band_code", "month_of_year"]
_CANDIDATES = {name: (name, params) for name, params in v.BASE_CANDIDATES.items()}
_FOREST = _CANDIDATES["random_forest"]
_CUT = dt.date(2000, 1, 1)


def _table(spark, folder):
    """Scaled order features; a third of the rows has no label."""
    df = applications(spark, folder)
    return df.select(
        "case_id", "day", "label", "dev", (F.col("amount") / 500000).alias("amount"), (F.col("balance") / 10000).alias("balance"),
        (level_code(F.col("band"), {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2, "5-LOW": 1}) / 5).alias("band_code"),
        (F.month("day") / 12).alias("month_of_year"))


def _setup(names=tuple(_CANDIDATES), **more):
    return training.Setup(day="day", label="label", keys=["case_id"], features=_FEATURES, tie="case_id",
                          candidates={n: _CANDIDATES[n] for n in names}, **more)


def _windows(spark):
    return rolling_windows(spark, DATA_START, CUT)


def _within(*columns):
    """Whether all of the columns lie between 0 and 1."""
    good = F.lit(True)
    for c in columns:
        good = good & F.coalesce(F.col(c).between(0, 1), F.lit(False))
    return good


_OOT = "oot AS (SELECT * FROM applications WHERE NOT dev)"
_STAGES = """placed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY day, case_id) AS rn, COUNT(*) OVER () AS n FROM applications WHERE NOT dev AND label IS NOT NULL),
staged AS (SELECT 'train' AS stage, label FROM applications WHERE dev AND label IS NOT NULL
  UNION ALL SELECT CASE WHEN rn <= (2 * n) // 3 THEN 'policy' ELSE 'holdout' END, label FROM placed)"""


def _names(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows)


def _parts(spark, folder):
    df = settled(_table(spark, folder))
    return df.where("dev").drop("dev"), df.where("not dev").drop("dev")


# every row takes part; one market segment in five makes the small class
_SKEWED = "skewed AS (SELECT CASE WHEN segment = 'BUILDING' THEN 0 ELSE 1 END AS y FROM applications)"
_COUNTS = "n AS (SELECT COUNT(*) FILTER (WHERE y = 1) AS p, COUNT(*) FILTER (WHERE y = 0) AS q FROM skewed)"


def _skewed(spark, folder):
    return applications(spark, folder).withColumns({
        "y": F.when(F.col("segment") == "BUILDING", 0).otherwise(1), "scaled": F.col("amount") / 500000})


@query("undersample", with_(APPLICATIONS, _SKEWED, _COUNTS, select="SELECT 1 AS y, LEAST(p, 2 * q) AS n FROM n UNION ALL SELECT 0, q FROM n"))
def undersample(spark, folder):
    return learners.undersampled(_skewed(spark, folder), "y", ["case_id"]).groupBy("y").agg(F.count("*").alias("n"))


@query("oversample", with_(APPLICATIONS, _SKEWED, _COUNTS, select="""SELECT 1 AS y, FALSE AS is_synthetic, p AS n, CAST(0 AS BIGINT) AS inside FROM n
  UNION ALL SELECT 0, FALSE, q, 0 FROM n UNION ALL SELECT 0, TRUE, p - q, p - q FROM n"""))
def oversample(spark, folder):
    made = learners.oversampled(_skewed(spark, folder), "y", ["case_id"], ["scaled", "balance"])
    # a row between two minority rows lies in their range
    small = made.where("y = 0 and not is_synthetic").agg(F.struct(*(f(c).alias(f"{n}_{c}") for c in ("scaled", "balance") for n, f in (("low", F.min), ("high", F.max)))).alias("r")).scalar()
    inside = F.col("scaled").between(small["low_scaled"], small["high_scaled"]) & F.col("balance").between(small["low_balance"], small["high_balance"])
    return made.groupBy("y", "is_synthetic").agg(F.count("*").alias("n"), F.count_if(F.col("is_synthetic") & inside).alias("inside"))


@query("class_weights", with_(APPLICATIONS, "n AS (SELECT COUNT(*) FILTER (WHERE label = 1) AS p, COUNT(*) FILTER (WHERE label = 0) AS q FROM applications)", select=f"""
  SELECT 'class_weight' AS strategy, 1 AS label, {R('(p + q) / (2e0 * p)')} AS weight FROM n UNION ALL SELECT 'class_weight', 0, {R('(p + q) / (2e0 * q)')} FROM n
  UNION ALL SELECT 'scale_weight', 1, {R('q / CAST(p AS DOUBLE)')} FROM n UNION ALL SELECT 'scale_weight', 0, 1e0 UNION ALL SELECT 'none', 1, 1e0 UNION ALL SELECT 'none', 0, 1e0"""))
def class_weights(spark, folder):
    rows = applications(spark, folder).where("label is not null")
    parts = [learners.weighted(rows, "label", s).groupBy(F.lit(s).alias("strategy"), "label").agg(F.max("weight").alias("weight"))
             for s in ("class_weight", "scale_weight", "none")]
    return tidy(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("train_rolling", with_(APPLICATIONS, WINDOWS, f"models AS (SELECT * FROM (VALUES {_names((n,) for n in _CANDIDATES)}) t(model_name))", select=f"""
  SELECT window_id, model_name, COUNT(*) FILTER (WHERE day <= train_end) AS train_rows, COUNT(*) FILTER (WHERE day >= monitor_start) AS monitor_rows,
    {R("AVG(label) FILTER (WHERE day <= train_end)")} AS train_positive_ratio, {R("AVG(label) FILTER (WHERE day >= monitor_start)")} AS monitor_positive_ratio, TRUE AS within
  FROM windows JOIN applications ON label IS NOT NULL AND day BETWEEN train_start AND monitor_end, models GROUP BY 1, 2"""))
def train_rolling(spark, folder):
    development, _ = _parts(spark, folder)
    cycles = training.evaluate_candidates(development, _windows(spark), _setup())
    within = _within("train_auc", "monitor_auc", "monitor_brier", "monitor_ks", "cv_auc_mean", "cv_f1_reject_mean")
    return tidy(cycles.select("window_id", "model_name", "train_rows", "monitor_rows", "train_positive_ratio", "monitor_positive_ratio", within.alias("within")))


_SCORES = with_(APPLICATIONS, select="SELECT case_id, TRUE AS within, TRUE AS monotone FROM applications WHERE NOT dev")


def _neighbours(df, value, score):
    """(rising, falling) of every two neighbouring distinct values: whether no score of the lower one is above, or below, one of the higher."""
    cells = df.groupBy(value).agg(F.min(score).alias("low"), F.max(score).alias("high"))
    placed = settled(add_bucket(cells, value, bucket_edges(df, value)))
    inside = placed.selectExpr("low", "high", *(f"lag({c}) over (partition by _bucket order by `{value}`) as {c}_before" for c in ("low", "high")))
    ends = placed.groupBy("_bucket").agg(*(f(c, value).alias(f"{c}{n}") for c in ("low", "high") for n, f in (("", F.min_by), ("_last", F.max_by))))
    across = ends.selectExpr("low", "high", *(f"lag({c}_last) over (order by _bucket) as {c}_before" for c in ("low", "high")))  # a row per bucket
    return inside.unionByName(across).select(
        (F.col("high_before") <= F.col("low") + 1e-12).alias("rising"), (F.col("low_before") >= F.col("high") - 1e-12).alias("falling"))


def _mapped(spark, folder, name, method):
    """Out-of-time rows, whether the score is a share, and whether no row with a lower raw score has a higher one."""
    development, oot = _parts(spark, folder)
    model = training.retrain(development, _setup(), name, method)
    raw = settled(learners.scored(model.score(oot), model.model, _FEATURES, "raw").select("case_id", "pred_prob", "raw"))
    # a sigmoid fitted to a model without any skill may fall
    ways = _neighbours(raw, "raw", "pred_prob").agg(F.bool_and("rising").alias("rising"), F.bool_and("falling").alias("falling"))
    rising = ways.select(F.coalesce("rising", F.lit(True)) | (F.coalesce("falling", F.lit(True)) & F.lit(method == "sigmoid"))).scalar()
    return raw.select("case_id", _within("pred_prob").alias("within"), rising.alias("monotone"))


@query("calibrated_scores", _SCORES)
def calibrated_scores(spark, folder):
    return _mapped(spark, folder, "random_forest", "isotonic")


@query("sigmoid_scores", _SCORES)
def sigmoid_scores(spark, folder):
    return _mapped(spark, folder, "logistic_regression", "sigmoid")


@query("batch_scores", with_(APPLICATIONS, select="SELECT COUNT(*) AS n, TRUE AS within, COUNT(*) AS zoned FROM applications WHERE NOT dev"))
def batch_scores(spark, folder):
    development, oot = _parts(spark, folder)
    model = training.retrain(development, _setup(), "logistic_regression", "none")
    batch = watch.score_batch(oot, model, ["case_id"], "v1", LOWER, UPPER)
    zone = F.when(F.col("pred_prob") < LOWER, 0).when(F.col("pred_prob") >= UPPER, 2).otherwise(1)
    return batch.agg(F.count("*").alias("n"), F.bool_and(_within("pred_prob")).alias("within"), F.count_if(F.col("pred_zone") == zone).alias("zoned"))


_FEATURE_ROWS = f"SELECT feature, TRUE AS consistent, COUNT(*) AS rows FROM applications, (VALUES {_names((f,) for f in _FEATURES)}) t(feature)"


@query("tree_importance", with_(APPLICATIONS, select=f"{_FEATURE_ROWS} WHERE dev GROUP BY 1"))
def tree_importance(spark, folder):
    development, _ = _parts(spark, folder)
    model = learners.fit(development, _FEATURES, "label", *_FOREST, keys=["case_id"])
    found = learners.tree_importance(model, _FEATURES, development)
    total = found.agg(F.abs(F.sum("gain") - 1) < 1e-6).scalar()
    rows = development.agg(F.count("*")).scalar()
    return found.select("feature", (_within("gain") & (F.col("weight") >= 0) & (F.col("cover") >= F.col("weight")) & total).alias("consistent"), rows.alias("rows"))


@query("permutation_importance", with_(APPLICATIONS, select=f"{_FEATURE_ROWS} WHERE NOT dev AND label IS NOT NULL GROUP BY 1"))
def permutation_importance(spark, folder):
    development, oot = _parts(spark, folder)
    model = learners.fit(development, _FEATURES, "label", *_FOREST, keys=["case_id"])
    score = lambda df: learners.scored(df, model, _FEATURES)
    found = learners.permutation_importance(oot, score, _FEATURES, "label", ["case_id"])
    auc = settled(metrics.classification_metrics(settled(score(oot).select("label", "pred_prob")), "label", "pred_prob").select("auc", "rows"))
    good = _within("auc", "permuted_auc") & (F.abs(F.col("auc") - auc.select("auc").scalar()) < 1e-9) & (
        F.abs(F.col("auc") - F.col("permuted_auc") - F.col("importance")) < 1e-9)
    return found.select("feature", good.alias("consistent"), auc.select("rows").scalar().alias("rows"))


@query("training_run", with_(APPLICATIONS, _STAGES, select=f"SELECT stage, COUNT(*) AS rows, {R('AVG(label)')} AS positive_ratio, TRUE AS within FROM staged GROUP BY 1"))
def training_run(spark, folder):
    development, oot = _parts(spark, folder)
    results = training.run_training(development, oot, _windows(spark), _setup(), method="sigmoid")
    within = _within("auc", "brier_score", "ks", "f1_reject", "precision", "recall")
    return tidy(results["stage_metrics"].select("stage", "rows", "positive_ratio", within.alias("within")))


def _pairs(candidates, methods) -> str:
    return _names((c[0], m) for c in candidates for m in methods)


@query("conservative_tuning", with_(APPLICATIONS, _STAGES, select=f"""SELECT config_id, calibration_method, TRUE AS within, TRUE AS ranked, COUNT(*) AS policy_rows
  FROM staged, (VALUES {_pairs(v.TUNING_CANDIDATES, v.TUNING_CALIBRATIONS)}) t(config_id, calibration_method) WHERE stage = 'policy' GROUP BY 1, 2"""))
def conservative_tuning(spark, folder):
    """Every candidate and calibration; a better score has a better place."""
    development, oot = _parts(spark, folder)
    setup = _setup()
    policy = settled(training.split_policy_holdout(oot.where("label is not null"), setup).where("split = 'policy'").drop("split"))
    tuned = training.tune(development, policy, _windows(spark), setup)
    better = F.expr("lag(tuning_score) over (order by tuning_rank)")  # one row per candidate and calibration
    within = _within("holdout_auc", "holdout_brier", "avg_monitor_auc")
    return tuned.select("config_id", "calibration_method", within.alias("within"), F.coalesce(better >= F.col("tuning_score"), F.lit(True)).alias("ranked"),
                        policy.agg(F.count("*")).scalar().alias("policy_rows"))


def _baseline(holdout):
    zoned = holdout.where("label is not null").select(
        F.col("label").alias("actual_label"), F.col("amount").alias("pred_prob")).withColumn(
        "pred_zone", F.when(F.col("pred_prob") < LOWER, 0).when(F.col("pred_prob") >= UPPER, 2).otherwise(1))
    return settled(challengers.holdout_figures(zoned, "baseline"))


@query("pruned_challenger", with_(APPLICATIONS, _STAGES, select=f"""SELECT metric, TRUE AS consistent, COUNT(*) AS holdout_rows
  FROM staged, (VALUES {_names((m,) for m in challengers.METRIC_COLUMNS)}) t(metric) WHERE stage = 'holdout' GROUP BY 1"""))
def pruned_challenger(spark, folder):
    development, oot = _parts(spark, folder)
    setup = _setup()
    holdout = training.split_policy_holdout(oot.where("label is not null"), setup).where("split = 'holdout'")
    results = challengers.pruned_challenger(development, oot, _windows(spark), setup, ["month_of_year"], _baseline(holdout), method="none")
    rows = results["holdout_predictions"].agg(F.count("*")).scalar()
    delta = F.col("challenger_value") - F.col("base_value")
    return results["comparison"].select("metric", (F.abs(delta - F.col("delta")) < 1e-6).alias("consistent"), rows.alias("holdout_rows"))


@query("decision_tuning_challenger", with_(APPLICATIONS, _STAGES, select=f"""SELECT config_id || '/' || method AS challenger, TRUE AS guarded, TRUE AS ranked, COUNT(*) AS holdout_rows
  FROM staged, (VALUES {_pairs(v.DECISION_CANDIDATES, v.DECISION_CALIBRATIONS)}) t(config_id, method) WHERE stage = 'holdout' GROUP BY 1"""))
def decision_tuning_challenger(spark, folder):
    """Every candidate and calibration; places follow the scores, and no upgrade breaks its first rule."""
    development, oot = _parts(spark, folder)
    setup = _setup()
    parts = settled(training.split_policy_holdout(oot.where("label is not null"), setup))
    policy, holdout = (parts.where(F.col("split") == p).drop("split") for p in ("policy", "holdout"))
    base = _baseline(holdout)
    results = challengers.decision_tuning_challenger(development, policy, holdout, _windows(spark), setup, base)
    gain = F.col("ch_low_zone_reject_precision") > F.col("base_low_zone_reject_precision") + v.UPGRADE["precision_gain"]
    decided = results["decision"]
    better = F.expr("lag(final_selection_score) over (partition by passes_hard_constraints order by selection_rank)")  # one row per candidate and calibration
    return decided.select(
        "challenger", (gain | (F.col("upgrade_candidate") == "reject")).alias("guarded"),
        F.coalesce(better >= F.col("final_selection_score"), F.lit(True)).alias("ranked"), holdout.agg(F.count("*")).scalar().alias("holdout_rows"))


@query("rescored_metrics", with_(APPLICATIONS, select=f"SELECT COUNT(*) AS rows, {R('AVG(label)')} AS positive_ratio, TRUE AS within FROM applications WHERE NOT dev AND label IS NOT NULL"))
def rescored_metrics(spark, folder):
    development, oot = _parts(spark, folder)
    model = learners.fit(development, _FEATURES, "label", *_CANDIDATES["boosted_trees"], keys=["case_id"])
    found = metrics.classification_metrics(learners.scored(oot, model, _FEATURES), "label", "pred_prob")
    return tidy(found.select("rows", "positive_ratio", _within("auc", "auc_pr", "brier_score", "ks", "f1", "f1_reject").alias("within")))


# ---- what a fit decides, held against SQL ---------------------------------------------
_STUMP = {"trees": 1, "depth": 1, "rate": 1.0}
#: Penalties of stumps on a feature of 50 levels; ``min_leaf`` is a share of all second derivatives.
_PENALTIES = {
    "none": {}, "l1": {"l1": 900.0}, "l2": {"l2": 5000.0}, "gamma": {"gamma": 1e12}, "max_step": {"max_step": 1.0}, "min_leaf": {"min_leaf": 0.35},
    "all": {"l1": 300.0, "l2": 700.0, "gamma": 1.0, "max_step": 1.2, "min_leaf": 0.3}}
_LABELLED = "labelled AS (SELECT quantity AS x, CASE WHEN score > 0.4e0 THEN 1 ELSE 0 END AS y FROM scored)"


def _stump_sql(name: str) -> str:
    """The best split of one level from its sums: derivatives of the log loss at a margin of 0."""
    p = {"l1": 0.0, "l2": 0.0, "gamma": 0.0, "max_step": 1e30, "min_leaf": 0.0} | _PENALTIES[name]
    # leaf weight, then its gain, of sums with the prefix a
    weight = lambda a: f"GREATEST(-{p['max_step']}, LEAST({p['max_step']}, -SIGN({a}g) * GREATEST(ABS({a}g) - {p['l1']}, 0) / ({a}h + {p['l2']})))"
    gain = lambda a: f"-(2 * {a}g * {a}w + ({a}h + {p['l2']}) * {a}w * {a}w + 2 * {p['l1']} * ABS({a}w))"
    kept = f"gain >= {max(p['gamma'], 1e-6)}"
    return with_(SCORED, _LABELLED, "levels AS (SELECT x, SUM(0.5e0 - y) AS g, 0.25e0 * COUNT(*) AS h FROM labelled GROUP BY 1)",
        "sums AS (SELECT x, SUM(g) OVER (ORDER BY x) AS lg, SUM(h) OVER (ORDER BY x) AS lh, SUM(g) OVER () AS g, SUM(h) OVER () AS h FROM levels)",
        "sides AS (SELECT *, g - lg AS rg, h - lh AS rh FROM sums WHERE lh < h)",
        f"weights AS (SELECT *, {weight('')} AS w, {weight('l')} AS lw, {weight('r')} AS rw FROM sides WHERE LEAST(lh, rh) >= {p['min_leaf']} * h)",
        f"gains AS (SELECT *, {gain('l')} + {gain('r')} - ({gain('')}) AS gain FROM weights)",
        "best AS (SELECT * FROM gains ORDER BY gain DESC, x LIMIT 1)",
        select=f"SELECT {kept} AS split, CASE WHEN {kept} THEN x END AS cut, {R('w')} AS value, "
               f"CASE WHEN {kept} THEN {R('lw')} END AS left_value, CASE WHEN {kept} THEN {R('rw')} END AS right_value FROM best")


def _stump(spark, folder, name):
    rows = scored(spark, folder).select("quantity", F.when(F.col("score") > 0.4, 1).otherwise(0).alias("y")).withColumns({
        "_set": F.lit(0), "weight": F.lit(1.0), "_aside": F.lit(False), "_spot": F.lit(0)})
    penalty = dict(_PENALTIES[name])
    penalty["min_leaf"] = penalty.get("min_leaf", 0.0) * 0.25 * rows.count()
    model = boosting.fit_many(rows, ["quantity"], "y", {"stump": boosting.Spec(**_STUMP, **penalty)})
    split = F.col("feature")[0] >= 0
    child = lambda i: F.when(split, F.col("value")[i])
    return tidy(model.select(split.alias("split"), F.when(split, F.col("cut")[0]).alias("cut"), F.col("value")[0].alias("value"),
                             child(1).alias("left_value"), child(2).alias("right_value")))


for _name in _PENALTIES:
    query(f"split_{_name}", _stump_sql(_name))(lambda spark, folder, name=_name: _stump(spark, folder, name))


@query("boosting_loss", with_(SCORED, _LABELLED, select="SELECT trees, COUNT(*) AS rows, TRUE AS lower FROM labelled, (VALUES (1), (5), (20), (60)) t(trees) GROUP BY 1"))
def boosting_loss(spark, folder):
    """More trees lower the loss on the rows they learned from, when nothing holds them back."""
    features = ["quantity", "discount", "tax"]
    rows = settled(scored(spark, folder).select(*features, F.when(F.col("score") > 0.4, 1).otherwise(0).alias("y")).withColumns({
        "_set": F.lit(0), "weight": F.lit(1.0), "_aside": F.lit(False), "_spot": F.lit(0)}))
    of = {str(n): boosting.Spec(trees=n, depth=3, rate=0.3, min_leaf=0.0) for n in (1, 5, 20, 60)}
    scores = boosting.score_many(rows, boosting.fit_many(rows, features, "y", of), features, of, ["y"])
    loss = -F.avg(F.log(F.when(F.col("y") == 1, F.col("pred_prob")).otherwise(1 - F.col("pred_prob"))))
    found = settled(scores.groupBy(F.col("_candidate").cast("int").alias("trees")).agg(F.count("*").alias("rows"), loss.alias("loss")))
    return found.select("trees", "rows", (F.col("loss") < F.expr("coalesce(lag(loss) over (order by trees), ln(2))")).alias("lower"))  # four rows


@query("early_stop", with_(SCORED, _LABELLED, select="SELECT COUNT(*) AS rows, TRUE AS stopped, TRUE AS patient FROM labelled"))
def early_stop(spark, folder):
    """Labels that no feature explains: boosting stops 30 rounds after its best loss on the rows kept aside, and keeps the rounds up to it."""
    rows = settled(scored(spark, folder).select("quantity", "discount", F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(2)).alias("y"), "l_orderkey", "l_linenumber"))
    of = {"patient": boosting.Spec(trees=400, depth=3, rate=0.3), "whole": boosting.Spec(trees=60, depth=3, rate=0.3, patience=10 ** 6)}
    models = learners.fit_trees(rows.withColumn("_set", F.lit(0)), ["quantity", "discount"], "y", of, strategy="none", keys=["l_orderkey", "l_linenumber"])
    kept = {r[0]: r[1] for r in models.select("_candidate", (F.size("value") / of["whole"].size).cast("int")).collect()}
    return rows.agg(F.count("*").alias("rows"), F.lit(kept["patient"] < 370).alias("stopped"), F.lit(kept["patient"] <= 60 and kept["whole"] <= 60).alias("patient"))


@query("tree_contributions", with_(APPLICATIONS, select="SELECT case_id, TRUE AS additive, TRUE AS same_base FROM applications WHERE NOT dev"))
def tree_contributions(spark, folder):
    """Exact contributions of every out-of-time row: with the base they add up to its margin, and the margin gives its score."""
    development, oot = _parts(spark, folder)
    model = learners.fit(development, _FEATURES, "label", *_CANDIDATES["boosted_trees"], keys=["case_id"])
    found = boosting.contributions(learners.scored(oot, model, _FEATURES), model, _FEATURES, ["case_id", "pred_prob"])
    total = F.col("base")
    for f in _FEATURES:
        total = total + F.col(f)
    additive = (F.abs(total - F.col("margin")) < 1e-9) & (F.abs(1 / (1 + F.exp(-F.col("margin"))) - F.col("pred_prob")) < 1e-9)
    base = found.agg(F.max("base") - F.min("base")).scalar()
    return found.select("case_id", additive.alias("additive"), (base == 0).alias("same_base"))


@query("contribution_ranking", with_(APPLICATIONS, select=f"SELECT feature, TRUE AS ranked FROM (VALUES {_names((f,) for f in _FEATURES)}) t(feature) WHERE EXISTS (SELECT * FROM applications WHERE NOT dev)"))
def contribution_ranking(spark, folder):
    development, oot = _parts(spark, folder)
    model = learners.fit(development, _FEATURES, "label", *_FOREST, keys=["case_id"])
    found = boosting.mean_contributions(oot, model, _FEATURES, ["case_id"])
    before = F.expr("lag(mean_abs) over (order by rank)")  # a row a feature
    return found.select("feature", F.coalesce(before >= F.col("mean_abs"), F.lit(True)).alias("ranked"))


def _resampled_fit(spark, folder, strategy):
    """Against a fit on the rows as they are, the mean score over all of them moves from their own share towards the even one."""
    rows = settled(_skewed(spark, folder).select("case_id", "y", "scaled", "balance", "day"))
    of = {"boosted": boosting.Spec.of("boosted_trees", v.BASE_CANDIDATES["boosted_trees"])}

    def mean(how: str):
        models = learners.fit_trees(rows.withColumn("_set", F.lit(0)), ["scaled", "balance"], "y", of, strategy=how, keys=["case_id"])
        return learners.scored(rows, boosting.model_of(models, 0, "boosted", of["boosted"]), ["scaled", "balance"]).agg(F.avg("pred_prob")).first()[0]

    moved = abs(mean(strategy) - 0.5) < abs(mean("none") - 0.5)
    return rows.agg(F.count("*").alias("rows"), F.lit(moved).alias("nearer_even_share"))


_RESAMPLED = with_(APPLICATIONS, select="SELECT COUNT(*) AS rows, TRUE AS nearer_even_share FROM applications")
query("fit_undersampled", _RESAMPLED)(lambda spark, folder: _resampled_fit(spark, folder, "undersample"))
query("fit_oversampled", _RESAMPLED)(lambda spark, folder: _resampled_fit(spark, folder, "smote"))
