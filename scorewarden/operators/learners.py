"""Fitting, calibrating, resampling and explaining models.

Models of all windows, folds and candidates are fitted in one pass (``boosting``, ``linear``). Tagging, scoring and metrics of
all of them are single DataFrame plans.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewarden.operators.boosting import Spec, TreeModel, counted, cut_points, cuts_of, fit_many, model_of, score_many, scored_by
from scorewarden.operators.features import assembled
from scorewarden.operators.linear import LinearModel, fit_linear, score_linear
from scorewarden.operators.metrics import class_balance, classification_metrics
from scorewarden.operators.neighbours import nearest_rows
from scorewarden.operators.ordering import bucket_count, smallest_by_hash
from scorewarden.operators.splits import month_folds, tag_windows
from scorewarden.storage import settled, small_side

SEED = 42


def hash_share(keys: Sequence[str], seed: int = SEED) -> Column:
    """A repeatable number in [0, 1) per row, from its key."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1_000_003)).cast("double") / 1_000_003


# ---- class imbalance ------------------------------------------------------------
def weighted(df: DataFrame, label: str, strategy: str, out: str = "weight") -> DataFrame:
    """Row weights: positives scaled to the negatives, balanced classes, or 1."""
    if strategy not in ("scale_weight", "class_weight"):
        return df.withColumn(out, F.lit(1.0))
    balance = class_balance(df, label)
    if strategy == "scale_weight":
        scale = balance.select("scale_weight").scalar()
        return df.withColumn(out, F.when(F.col(label) == 1, scale).otherwise(1.0))
    both = balance.select(F.struct("weight_positive", "weight_negative").alias("w")).scalar()
    return df.withColumn(out, F.when(F.col(label) == 1, both["weight_positive"]).otherwise(both["weight_negative"]))


def undersampled(df: DataFrame, label: str, keys: Sequence[str], times: int = 2, seed: int = SEED) -> DataFrame:
    """All negatives and exactly min(positives, times x negatives) positives, chosen by a seeded hash."""
    negatives = df.where(F.col(label) == 0)
    limit = times * negatives.count()
    kept = smallest_by_hash(df.where(F.col(label) == 1), keys, f"least(n, {limit}L)", seed)
    return negatives.unionByName(kept)


def oversampled(
    df: DataFrame, label: str, keys: Sequence[str], features: Sequence[str], k: int = 5, seed: int = SEED,
) -> DataFrame:
    """The rows plus synthetic rows of the minority class, so that both classes are equally many.

    A synthetic row lies between a minority row and one of its k nearest minority
    rows, which are exact. The result depends on the rows alone, not on how they
    are spread over tasks. A single minority row has no neighbour and is repeated.
    Keys must identify rows. Result columns: keys (null on synthetic rows),
    features, label, ``is_synthetic``.
    """
    balance = class_balance(df, label).first()
    minority = 1 if balance["positives"] < balance["negatives"] else 0
    few, many = sorted((balance["positives"], balance["negatives"]))
    original = df.where(F.col(label).isNotNull()).select(
        *keys, *(F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f) for f in features), F.col(label).cast("int").alias(label),
        F.lit(False).alias("is_synthetic"))
    if few == 0 or few == many:
        return original
    rows = settled(original.where(F.col(label) == minority).select(
        F.to_json(F.struct(*keys)).alias("_id"), F.array(*features).alias("_x"), F.xxhash64(F.lit(seed), *keys).alias("_h")))
    near = nearest_rows(rows, k, key="_id").groupBy("_id").agg(
        F.array_sort(F.collect_list(F.struct("place", F.col("_x").alias("x")))).alias("_near"))  # at most k
    # settled: the copies are drawn from it in two passes
    nearest = settled(rows.join(near, "_id", "left").withColumn(
        "_near", F.coalesce("_near", F.array(F.struct(F.lit(1).alias("place"), F.col("_x").alias("x"))))))
    times, extra = divmod(many - few, few)
    plan = nearest.select("*", F.lit(times).alias("_times"))
    if extra:
        lucky = smallest_by_hash(nearest.select("_id"), ["_id"], f"{extra}L", seed + 1).withColumn("_extra", F.lit(1))
        plan = plan.join(lucky, "_id", "left").withColumn("_times", F.col("_times") + F.coalesce("_extra", F.lit(0)))
    unit = lambda salt: f"pmod(xxhash64(_h, _copy, {salt}), 1000003) / 1000003D"
    made = (
        plan.where("_times > 0").selectExpr("_x", "_h", "_near", "explode(sequence(1, _times)) as _copy")
        .selectExpr("_x", f"_near[int(floor({unit(1)} * size(_near)))].x as _y", f"{unit(2)} as _u")
        .selectExpr("zip_with(_x, _y, (a, b) -> a + (b - a) * _u) as _z")
        .select(*(F.col("_z")[i].alias(f) for i, f in enumerate(features)), F.lit(minority).alias(label), F.lit(True).alias("is_synthetic"))
    )
    return original.unionByName(made, allowMissingColumns=True)


def resampled(df: DataFrame, label: str, strategy: str, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Training rows under the chosen strategy; evaluation rows must keep their true mix."""
    if strategy == "undersample":
        return undersampled(df, label, keys)
    if strategy == "smote":
        return oversampled(df, label, keys, features).drop("is_synthetic")
    return df


# ---- learners -------------------------------------------------------------------
TREES = ("boosted_trees", "random_forest")


def specs(candidates: Mapping[str, tuple[str, Mapping[str, float]]]) -> dict[str, Spec]:
    """The tree candidates among (learner, parameters) by name."""
    return {n: Spec.of(kind, p) for n, (kind, p) in candidates.items() if kind in TREES}


def linears(candidates: Mapping[str, tuple[str, Mapping[str, float]]]) -> dict[str, Mapping[str, float]]:
    """The linear candidates among (learner, parameters) by name."""
    unknown = {kind for kind, _ in candidates.values()} - {*TREES, "logistic_regression"}
    if unknown:
        raise ValueError(f"unknown learners {sorted(unknown)}")
    return {n: p for n, (kind, p) in candidates.items() if kind not in TREES}


def training_rows(
    df: DataFrame, features: Sequence[str], label: str, *, strategy: str, keys: Sequence[str], stop_share: float, seed: int,
) -> DataFrame:
    """Rows of all sets (``_set``) as a tree fit takes them: label, features, weight, ``_aside`` and ``_spot``.

    The part kept aside is chosen by its keys before rows are made or left out, and keeps its true mix of classes; weights
    are those of the rows learned from. Resampling goes set by set.
    """
    aside = hash_share(keys, seed) < stop_share if keys and stop_share else F.lit(False)
    rows = df.where(F.col(label).isNotNull()).withColumn("_aside", aside)
    if strategy in ("undersample", "smote"):
        sets = sorted(r[0] for r in rows.select("_set").distinct().collect())  # windows and folds
        learned = [resampled(rows.where(f"_set = {s} and not _aside"), label, strategy, keys, features).select(
            *keys, *features, label).withColumns({"_set": F.lit(s), "_aside": F.lit(False)}) for s in sets]
        rows = reduce(DataFrame.unionByName, [*learned, rows.where("_aside").select(*keys, *features, label, "_set", "_aside")])
    counts = rows.where("not _aside").groupBy("_set").agg(
        F.sum((F.col(label) == 1).cast("double")).alias("_p"), F.sum((F.col(label) == 0).cast("double")).alias("_q"))
    positive = F.col(label) == 1
    weight = F.lit(1.0)
    if strategy == "scale_weight":
        weight = F.when(positive & (F.col("_p") > 0) & (F.col("_q") > 0), F.try_divide("_q", "_p")).otherwise(1.0)
    elif strategy == "class_weight":
        weight = F.coalesce(F.try_divide(F.col("_p") + F.col("_q"), 2 * F.when(positive, F.col("_p")).otherwise(F.col("_q"))), F.lit(1.0))
    marked = rows.join(small_side(counts), "_set", "left").withColumn("weight", F.coalesce(weight, F.lit(1.0)))
    return marked.withColumn("_spot", F.xxhash64(F.lit(seed), *keys, *features)).select(
        "_set", F.col(label).alias("_label"), *features, "weight", "_aside", "_spot")


def fit_trees(
    df: DataFrame, features: Sequence[str], label: str, candidates: Mapping[str, Spec], *, strategy: str = "scale_weight",
    keys: Sequence[str] = (), stop_share: float = 0.15, seed: int = SEED, **more,
) -> DataFrame:
    """Models of every set (``_set``) and candidate. Boosting stops early on a part of the training rows, never on later ones."""
    parts = []
    if strategy not in ("undersample", "smote") and more.get("cuts") is None:  # both kinds of trees have the same rows
        more = more | {"cuts": cut_points(df.where(F.col(label).isNotNull()), features, more.get("bins", 64))}
    for forest in (False, True):
        of = {n: c for n, c in candidates.items() if c.forest == forest}
        if of:
            rows = training_rows(df, features, label, strategy=strategy, keys=keys, stop_share=0 if forest else stop_share, seed=seed)
            parts.append(fit_many(rows, features, "_label", of, **more))
    return reduce(DataFrame.unionByName, parts)


def fit(
    df: DataFrame, features: Sequence[str], label: str, kind: str, params: Mapping[str, float], *,
    strategy: str = "scale_weight", keys: Sequence[str] = (), stop_share: float = 0.15, seed: int = SEED,
) -> LinearModel | TreeModel:
    """Fit one model."""
    of, lines, one = specs({kind: (kind, params)}), linears({kind: (kind, params)}), df.withColumn("_set", F.lit(0))
    if of:
        models = fit_trees(one, features, label, of, strategy=strategy, keys=keys, stop_share=stop_share, seed=seed)
        return model_of(models, 0, kind, of[kind])
    return fit_lines(one, features, label, lines, strategy=strategy, keys=keys)[0, kind]


def fit_lines(
    df: DataFrame, features: Sequence[str], label: str, candidates: Mapping[str, Mapping[str, float]], *, strategy: str, keys: Sequence[str],
) -> dict[tuple[int, str], LinearModel]:
    """Logistic regressions by (set, candidate)."""
    rows = training_rows(df, features, label, strategy=strategy, keys=keys, stop_share=0, seed=SEED)
    return fit_linear(rows, features, "_label", candidates)


def scored(df: DataFrame, model: LinearModel | TreeModel, features: Sequence[str], out: str = "pred_prob") -> DataFrame:
    """The rows with the probability of label 1. Rows without a label are scored too."""
    if isinstance(model, TreeModel):
        return scored_by(df, model, features, out)
    return df.withColumn(out, model.probability(features))


# ---- calibration ----------------------------------------------------------------
class Calibrated:
    """A model with a monotone map from its score to a probability.

    The map is fitted on out-of-fold scores, the model itself on all rows. (The
    alternative, an average of the fold models, scores k times as much.)
    """

    def __init__(self, model: LinearModel | TreeModel, mapping: Model | None, features: Sequence[str]):
        self.model, self.mapping, self.features = model, mapping, list(features)

    def score(self, df: DataFrame, out: str = "pred_prob") -> DataFrame:
        raw = scored(df, self.model, self.features, "_raw")
        if self.mapping is None:
            return raw.withColumnRenamed("_raw", out)
        kept = [c for c in raw.columns if c != "_raw"]
        if isinstance(self.mapping, LogisticRegressionModel):  # as a column: tasks need no model
            margin = F.lit(float(self.mapping.coefficients[0])) * F.col("_raw") + F.lit(float(self.mapping.intercept))
            return raw.select(*kept, (1 / (1 + F.exp(-margin))).alias(out))
        mapped = self.mapping.transform(assembled(raw.withColumn("_y", F.lit(0)), ["_raw"], "_y", "features").drop("_y"))
        return mapped.select(*kept, F.col("_cal").alias(out))


def calibration_cells(df: DataFrame, label: str, score: str, places: int | None = None, count: str | None = None) -> DataFrame:
    """Mean label and row count per distinct score; with ``places``, per rounded score, at most 10^places + 1 rows.

    ``count`` names the number of rows that each stands for.
    """
    n = F.lit(1) if count is None else F.col(count)
    return df.groupBy((F.col(score) if places is None else F.round(score, places)).alias("_raw")).agg(
        (F.sum(F.col(label).cast("double") * n) / F.sum(n)).alias("label"), F.sum(n).cast("double").alias("weight"))


def judged_cells(df: DataFrame, models: Sequence[Calibrated], features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(*keep, *features, _n): what the models tell apart of the rows, settled; each row stands for ``_n`` rows that get its scores.

    Trees see no more of a row than between which of their cuts it lies; any other model sees its numbers.
    """
    raw = [m.model for m in models]
    if not all(isinstance(m, TreeModel) for m in raw):
        return settled(df.select(*keep, *features, F.lit(1).cast("long").alias("_n")))
    cuts = [np.unique(np.concatenate([[], *(m.cuts[f] for m in raw if f < m.features)])) for f in range(len(features))]
    return settled(counted(df.select(*keep, *features), features, cuts, keep))


def fit_calibrated(
    df: DataFrame, features: Sequence[str], label: str, kind: str, params: Mapping[str, float], *, keys: Sequence[str],
    method: str = "isotonic", folds: int = 5, strategy: str = "scale_weight", places: int | None = None,
) -> Calibrated:
    """Fit on all rows; calibrate on scores that each row got from a model that did not see it."""
    return fit_methods(
        df, features, label, kind, params, keys=keys, methods=[method], folds=folds, strategy=strategy, places=places)[method]


def fit_methods(
    df: DataFrame, features: Sequence[str], label: str, kind: str, params: Mapping[str, float], *, keys: Sequence[str],
    methods: Sequence[str], folds: int = 5, strategy: str = "scale_weight", places: int | None = None,
) -> dict[str, Calibrated]:
    """One model per calibration method, all from the same fits: one on all rows and, if any method needs it, one per fold."""
    return fit_all_methods(
        df, features, label, {kind: (kind, params)}, keys=keys, methods=methods, folds=folds, strategy=strategy, places=places)[kind]


def fit_all_methods(
    df: DataFrame, features: Sequence[str], label: str, candidates: Mapping[str, tuple[str, Mapping[str, float]]], *,
    keys: Sequence[str], methods: Sequence[str], folds: int = 5, strategy: str = "scale_weight", places: int | None = None,
) -> dict[str, dict[str, Calibrated]]:
    """Per candidate, one model per calibration method; the trees of all candidates and folds are fitted in one pass.

    Out-of-fold scores are computed once, of trees for rows between the same cuts together. A map sees every distinct score; ``places``
    rounds them first, which bounds the rows that the isotonic map sees.
    """
    labelled = df.where(F.col(label).isNotNull()).withColumn("_fold", F.pmod(F.xxhash64(*keys), F.lit(folds)))
    needed = folds if set(methods) - {"none"} else 0
    trees, lines, final, held_out = specs(candidates), linears(candidates), {}, {}
    # set number ``folds`` has all rows
    sets = F.filter(F.array(*(F.lit(i).cast("long") for i in (*range(needed), folds))), lambda s: s != F.col("_fold"))
    learned, own = labelled.withColumn("_set", F.explode(sets)), labelled.withColumn("_set", F.col("_fold"))
    if trees:
        # each row is in equally many sets, so that their shares are those of the rows
        cuts = None if strategy in ("undersample", "smote") else cut_points(labelled, features)
        models = fit_trees(learned, features, label, trees, strategy=strategy, keys=keys, cuts=cuts)
        final |= {n: model_of(models, folds, n, spec) for n, spec in trees.items()}
        if needed:
            cells = counted(own, features, cuts_of(models, len(features)), ["_set", label])
            scores = settled(_added_up(score_many(cells, models, features, trees, [label, "_n"], "_raw"), ["_candidate", label, "_raw"]))
            held_out |= {n: scores.where(F.col("_candidate") == n) for n in trees}
    if lines:
        weights = fit_lines(learned, features, label, lines, strategy=strategy, keys=keys)
        final |= {n: weights[folds, n] for n in lines}
        if needed:
            scores = score_linear(own, weights, features, [label], "_raw").withColumn("_n", F.lit(1))
            scores = settled(_added_up(scores, ["_candidate", label, "_raw"]))
            held_out |= {n: scores.where(F.col("_candidate") == n) for n in lines}
    cells = {n: settled(assembled(calibration_cells(h, label, "_raw", places, "_n"), ["_raw"], "label", "features")) for n, h in held_out.items()}
    return {n: {m: Calibrated(final[n], None if m == "none" else _score_map(cells[n], m), features) for m in methods} for n in candidates}


def _added_up(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    return scores.groupBy(*by).agg(F.sum("_n").alias("_n"))


def _score_map(cells: DataFrame, method: str) -> Model:
    if method == "isotonic":
        mapping = IsotonicRegression(weightCol="weight", predictionCol="_cal").fit(cells)
    else:  # two weighted rows per cell turn the mean label back into labels
        both = F.inline(F.array(
            F.struct(F.lit(1.0).alias("y"), (F.col("weight") * F.col("label")).alias("w")),
            F.struct(F.lit(0.0).alias("y"), (F.col("weight") * (1 - F.col("label"))).alias("w"))))
        mapping = LogisticRegression(labelCol="y", weightCol="w").fit(cells.select("features", both).where("w > 0"))
    return mapping


# ---- rolling evaluation -----------------------------------------------------------
def rolling_cycles(
    df: DataFrame, windows: DataFrame, *, day: str, label: str, keys: Sequence[str], features: Sequence[str],
    candidates: Mapping[str, tuple[str, Mapping[str, float]]], strategy: str = "scale_weight", cv_splits: int = 2,
    cv: bool = True, month: str | None = None,
) -> DataFrame:
    """One row per (window, model): walk-forward CV means and deviations, monitor and train metrics.

    ``candidates`` maps a name to (learner, parameters). The number of fits is
    windows x models x (1 + folds); fits of a kind share one pass, and all metrics
    are computed in one grouped plan. With ``month``, the yyyy-MM partition column
    of the table, only the months of the windows are opened.
    """
    labelled = df.where(F.col(label).isNotNull())
    if month:
        first, last = windows.agg(F.min("train_start"), F.max("monitor_end")).first()
        labelled = labelled.where(F.col(month).cast("string").between(f"{first:%Y-%m}", f"{last:%Y-%m}"))
    everything = _rolling_scores(
        labelled.select(*keys, day, label, *features), windows, day, label, keys, features, candidates, strategy, cv_splits if cv else 0)
    group = ["window_id", "model_name", "phase", "fold"]
    metrics = settled(classification_metrics(everything, label, "pred_prob", group, count="_n"))
    watched, pair = everything.where("phase = 'monitor'"), ["window_id", "model_name"]
    means = watched.groupBy(*pair).agg(F.sum("_n").alias("_rows"), (F.sum(F.col("pred_prob") * F.col("_n")) / F.sum("_n")).alias("monitor_score_mean"))
    off = F.col("pred_prob") - F.col("monitor_score_mean")
    spread = watched.join(F.broadcast(means), pair).groupBy(*pair, "monitor_score_mean").agg(  # a mean per window and model
        F.sqrt(F.sum(off * off * F.col("_n")) / F.max("_rows")).alias("monitor_score_std"))
    at = lambda phase: metrics.where(F.col("phase") == phase)
    monitor = at("monitor").select(
        "window_id", "model_name", F.col("rows").alias("monitor_rows"), F.col("positive_ratio").alias("monitor_positive_ratio"),
        *(F.col(m).alias(f"monitor_{n}") for m, n in (
            ("auc", "auc"), ("f1", "f1"), ("f1_reject", "f1_reject"), ("precision", "precision"), ("recall", "recall"),
            ("ks", "ks"), ("brier_score", "brier"))))
    train = at("train").select(
        "window_id", "model_name", F.col("rows").alias("train_rows"), F.col("positive_ratio").alias("train_positive_ratio"),
        F.col("auc").alias("train_auc"), F.col("brier_score").alias("train_brier"))
    folds = at("cv").groupBy("window_id", "model_name").agg(
        *(f(m).alias(f"cv_{m}_{s}") for m in ("auc", "f1", "f1_reject") for f, s in ((F.avg, "mean"), (F.stddev_pop, "std"))),
        F.avg("precision").alias("cv_precision_mean"), F.avg("recall").alias("cv_recall_mean"))
    return monitor.join(train, pair).join(spread, pair).join(folds, pair, "left").withColumn(
        "imbalance_strategy", F.lit(strategy))


def _rolling_scores(
    rows: DataFrame, windows: DataFrame, day: str, label: str, keys: Sequence[str], features: Sequence[str],
    candidates: Mapping[str, tuple[str, Mapping[str, float]]], strategy: str, cv_splits: int,
) -> DataFrame:
    """Scores of all windows and folds, each with its number of rows ``_n``; a set is a window, with its fold in the last two digits.

    Rows are kept once, not per window and fold; what trees tell apart of them is counted before it is scored.
    """
    tagged = tag_windows(settled(rows), windows, day).select(*keys, day, label, *features, "window_id", "phase")
    whole = tagged.withColumns({"fold": F.lit(0), "_learn": F.col("phase") == "train", "_judge": F.lit(True)})
    sets = whole
    if cv_splits:
        folds = month_folds(tagged.where("phase = 'train'"), day, ["window_id"], n_splits=cv_splits)
        sets = whole.unionByName(folds.withColumns({
            "phase": F.lit("cv"), "_learn": F.col("role") == "train", "_judge": F.col("role") == "validate"}).drop("role"))
    sets = sets.withColumn("_set", F.col("window_id") * 100 + F.col("fold"))
    trees, lines, keep = specs(candidates), linears(candidates), ["window_id", "phase", "fold", label]
    learned, judged, scores = sets.where("_learn"), sets.where("_judge"), []
    if trees:
        models = fit_trees(learned, features, label, trees, strategy=strategy, keys=keys)
        cells = counted(judged, features, cuts_of(models, len(features)), ["_set", *keep])
        scores.append(score_many(cells, models, features, trees, [*keep, "_n"]))
    if lines:
        weights = fit_lines(learned, features, label, lines, strategy=strategy, keys=keys)
        scores.append(score_linear(judged, weights, features, keep).withColumn("_n", F.lit(1).cast("long")))
    both = reduce(DataFrame.unionByName, scores).withColumnRenamed("_candidate", "model_name")
    return settled(_added_up(both, ["window_id", "model_name", "phase", "fold", label, "pred_prob"]))


# ---- explanation ------------------------------------------------------------------
def tree_importance(model: TreeModel, features: Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, gain, weight, cover): normalised gain, the number of splits and the training rows that passed them.

    """
    inner = model.feature >= 0
    at = model.feature[inner]
    total = lambda v: [float(x) for x in np.bincount(at, v[inner], minlength=len(features))]
    gains, splits, seen = total(model.gain), total(np.ones_like(model.gain)), total(model.rows)
    whole = sum(gains) or 1.0
    rows = [(f, gains[i] / whole, splits[i], seen[i]) for i, f in enumerate(features)]
    return df.sparkSession.createDataFrame(rows, "feature string, gain double, weight double, cover double")


def permutation_importance(
    df: DataFrame, score: Callable[[DataFrame], DataFrame], features: Sequence[str], label: str, keys: Sequence[str],
    out: str = "pred_prob", groups: int | None = None, seed: int = SEED,
) -> DataFrame:
    """(feature, auc, permuted_auc, importance): AUC lost when a feature's values change hands.

    Rows are dealt into hash groups and each takes the value of its predecessor
    in a hash order within the group, the first that of the last. So every value
    is used exactly once and no task sees more than its groups. All features are
    scored in one plan, once: the metrics read the scores several times.
    """
    kept = df.where(F.col(label).isNotNull()).select(*keys, label, *features)
    groups = groups or 4 * bucket_count(df)
    dealt = kept.withColumn("_g", F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(groups)))
    order = f"over (partition by _g order by xxhash64({seed + 1}, {', '.join(f'`{k}`' for k in keys)}), {', '.join(f'`{k}`' for k in keys)}"
    moved = dealt.selectExpr(
        "*", f"lag(struct({', '.join(f'`{f}`' for f in features)})) {order}) as _prev",
        f"last_value(struct({', '.join(f'`{f}`' for f in features)})) {order} rows between unbounded preceding"
        " and unbounded following) as _last",
    ).withColumn("_prev", F.coalesce("_prev", "_last")).drop("_last")
    variants = [F.struct(F.lit("").alias("feature"), *features)] + [
        F.struct(F.lit(f).alias("feature"), *(F.col("_prev")[c].alias(c) if c == f else F.col(c) for c in features))
        for f in features]
    rows = moved.select(*keys, label, F.inline(F.array(*variants)))
    scores = settled(score(rows).select("feature", label, out))
    result = settled(classification_metrics(scores, label, out, ["feature"]).select("feature", "auc"))
    base = result.where("feature = ''").select("auc").scalar()
    return result.where("feature != ''").select(
        "feature", base.alias("auc"), F.col("auc").alias("permuted_auc"), (base - F.col("auc")).alias("importance"))
