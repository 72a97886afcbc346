"""Trees and linear fits: both ways of growing, penalties, stopping, contributions, and agreement with plain versions."""

from __future__ import annotations

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from scorewarden.operators import boosting, learners, linear
from scorewarden.operators.features import assembled

FEATURES = ["a", "b", "c"]
SPECS = {
    "boosted": boosting.Spec(trees=5, depth=3, rate=0.3, min_leaf=2, subsample=0.8, columns=0.7, l1=0.2, l2=1, gamma=0.3, max_step=1, patience=4),
    "forest": boosting.Spec(trees=3, depth=3, min_leaf=5, min_split=12, forest=True)}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    made = [(s, i, *map(float, x), int(rng.random() < 1 / (1 + np.exp(-(2 * x[0] - x[0] * x[1]))))) for s in range(2) for i, x in enumerate(rng.normal(size=(400, 3)))]
    made += [(0, 1000, None, float("nan"), 0.0, 1), (0, 1001, 0.0, 0.0, 0.0, None)]
    return spark.createDataFrame(made, "_set long, id long, a double, b double, c double, y int").withColumns({
        "weight": F.lit(1.0), "_aside": F.pmod(F.xxhash64("id"), F.lit(7)) == 0, "_spot": F.xxhash64("id", "_set")}).cache()


def test_levels_over_all_tasks_give_the_trees_of_single_tasks(rows):
    alone = boosting.fit_many(rows, FEATURES, "y", SPECS).orderBy("_set", "_candidate").collect()
    spread = boosting.fit_many(rows.repartition(5), FEATURES, "y", SPECS, task_bytes=1).orderBy("_set", "_candidate").collect()
    assert [(r["_set"], r["_candidate"]) for r in alone] == [(r["_set"], r["_candidate"]) for r in spread] and len(alone) == 4
    for one, other in zip(alone, spread, strict=True):
        assert one["feature"] == other["feature"] and one["cut"] == other["cut"]
        for k in ("value", "gain", "cover", "rows"):
            assert np.allclose(one[k], other[k])


def test_scores_do_not_depend_on_the_order_of_rows_and_odd_rows_are_defined(spark, rows):
    models = boosting.fit_many(rows, FEATURES, "y", SPECS)
    again = boosting.fit_many(rows.orderBy(F.desc("_spot")), FEATURES, "y", SPECS)
    scores = lambda m: {(r["_set"], r["_candidate"], r["id"]): r["pred_prob"] for r in boosting.score_many(rows, m, FEATURES, SPECS, ["id"]).collect()}
    one, other = scores(models), scores(again)
    assert len(one) == 2 * rows.count() and all(abs(one[k] - other[k]) < 1e-9 for k in one)
    assert one[0, "boosted", 1000] == one[0, "boosted", 1001]  # nulls and NaN are 0, rows without a label are scored
    assert boosting.fit_many(rows.limit(0), FEATURES, "y", SPECS).count() == 0
    nothing = boosting.model_of(boosting.fit_many(rows.limit(0), FEATURES, "y", SPECS), 0, "boosted", SPECS["boosted"])
    assert {r["pred_prob"] for r in boosting.scored_by(rows.select("id", *FEATURES), nothing, FEATURES).collect()} == {0.5}
    constant = rows.withColumns({f: F.lit(1.0) for f in FEATURES})
    assert boosting.fit_many(constant, FEATURES, "y", SPECS).where("array_max(feature) >= 0").count() == 0


def expected(f, c, v, cover, x, known, node=0):
    """Mean value of a tree where only ``known`` features are told: others go both ways by cover."""
    if f[node] < 0:
        return v[node]
    left, right = 2 * node + 1, 2 * node + 2
    if f[node] in known:
        return expected(f, c, v, cover, x, known, right if x[f[node]] > c[node] else left)
    return sum(cover[n] / cover[node] * expected(f, c, v, cover, x, known, n) for n in (left, right))


@pytest.mark.parametrize("name", list(SPECS))
def test_contributions_are_shapley_values_over_all_subsets(rows, name):
    spec = SPECS[name]
    model = boosting.model_of(boosting.fit_many(rows, FEATURES, "y", SPECS), 1, name, spec)
    x = np.array([r[:] for r in rows.where("_set = 1").select(*FEATURES).orderBy("id").limit(25).collect()])
    got = model.contributions(x)
    scale = 1 / len(model.feature) if spec.forest else spec.rate
    for row, one in zip(x, got, strict=True):
        value = lambda known: sum(scale * expected(f, c, v, w, row, known) for f, c, v, w in zip(model.feature, model.cut, model.value, model.cover, strict=True))  # noqa: B023, E731
        want = [sum(factorial(k) * factorial(2 - k) / 6 * (value({*s, i}) - value(set(s))) for k in range(3) for s in combinations({0, 1, 2} - {i}, k)) for i in range(3)]
        assert np.allclose(one, [*want, value(set())])
    assert np.allclose(got.sum(1), model.margins(x))
    table = boosting.contributions(rows, model, FEATURES, ["id"]).where("abs(base + a + b + c - margin) > 1e-9")
    assert table.count() == 0


def test_weak_splits_are_taken_back_from_the_bottom():
    rng = np.random.default_rng(1)
    bins = rng.integers(0, 8, (600, 2)).astype(np.uint8)
    y = (bins[:, 0] > 3).astype(float)
    h = np.arange(600, dtype=np.uint64)
    grow = lambda gamma: boosting.grow(bins, y, np.ones(600), h, np.zeros(600), 0, boosting.Spec(depth=3, min_leaf=0, gamma=gamma, l2=1), 8)
    assert (grow(5.0).feature >= 0).sum() == 1 and (grow(1e9).feature >= 0).sum() == 0
    kept = grow(5.0)
    assert kept.gain[0] > 5 and kept.rows[0] == 600 and set(kept.feature[1:3]) == {-1} and set(kept.feature[3:]) == {-2}


def test_patience_stops_and_keeps_the_best_rounds():
    stop = boosting.Stopping(boosting.Spec(trees=100, patience=3))
    assert [stop.over(x) for x in (5.0, 4.0, 4.5, 4.4, 4.1)] == [False] * 4 + [True] and stop.at == 2
    alone = boosting.Stopping(boosting.Spec(trees=4, patience=1))
    assert [alone.over(None) for _ in range(4)] == [False, False, False, True] and alone.at == 4


def test_linear_fits_of_all_sets_equal_single_fits(rows):
    candidates = {"c1": {"C": 0.5, "max_iter": 100}, "c2": {"C": 0.01, "max_iter": 100}}
    found = linear.fit_linear(rows, FEATURES, "y", candidates)
    assert set(found) == {(s, c) for s in (0, 1) for c in candidates}
    for (s, c), model in found.items():
        own = rows.where(f"_set = {s} and y is not null")
        other = LogisticRegression(regParam=1 / (candidates[c]["C"] * own.count()), standardization=False, tol=1e-12, maxIter=500).fit(
            assembled(own.withColumn("label", F.col("y")), FEATURES, "label"))
        assert np.allclose(model.weights, [*other.coefficients, other.intercept], atol=1e-5)
    scores = linear.score_linear(rows, found, FEATURES, ["id"])
    assert scores.count() == 2 * rows.count()
    one = scores.where("id = 5 and _set = 1 and _candidate = 'c1'").first()["pred_prob"]
    assert one == pytest.approx(rows.where("id = 5 and _set = 1").select(found[1, "c1"].probability(FEATURES)).first()[0])
    assert linear.fit_linear(rows.limit(0), FEATURES, "y", candidates) == {}


def test_one_class_and_separable_rows_have_finite_weights(spark):
    df = spark.createDataFrame([(0, float(i), 1) for i in range(20)] + [(1, float(i - 10), int(i > 10)) for i in range(20)], "_set long, a double, y int").withColumn("weight", F.lit(1.0))
    found = linear.fit_linear(df, ["a"], "y", {"c": {"C": 0.5, "max_iter": 50}})
    assert all(np.isfinite(m.weights).all() for m in found.values()) and found[1, "c"].weights[0] > 0


@pytest.mark.parametrize("strategy", ["none", "scale_weight", "class_weight", "undersample", "smote"])
def test_all_strategies_fit_every_set(spark, rows, strategy):
    of = {"boosted": boosting.Spec(trees=3, depth=2, rate=0.3, min_leaf=1.0)}
    models = learners.fit_trees(rows.drop("weight", "_aside", "_spot"), FEATURES, "y", of, strategy=strategy, keys=["id"])
    assert sorted(r["_set"] for r in models.collect()) == [0, 1] and models.where("array_max(feature) < 0").count() == 0


@pytest.mark.parametrize("rows_", [50, 5000])
def test_rows_find_their_places_node_by_node_and_row_by_row(rows_):
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 16, (3, rows_)).astype(np.uint8)
    feature, cut = rng.integers(-1, 3, 31), rng.integers(0, 16, 31)
    for i in range(15):  # nothing splits below a leaf
        if feature[i] < 0:
            feature[[2 * i + 1, 2 * i + 2]] = -2
    got = boosting.reached(feature, 4)[boosting.paths(bins, feature, cut, 4)]
    for x, node in zip(bins.T, got, strict=True):
        at = 0
        while at < 15 and feature[at] >= 0:
            at = 2 * at + 1 + int(x[feature[at]] > cut[at])
        assert at == node


def test_leaves_at_the_full_depth_need_no_pass_over_the_rows(monkeypatch):
    rng = np.random.default_rng(4)
    bins, seen = rng.integers(0, 8, (500, 2)).astype(np.uint8), []
    plain = boosting.histograms
    monkeypatch.setattr(boosting, "histograms", lambda *a: seen.append(a[2]) or plain(*a))
    y = (bins[:, 0] + bins[:, 1] > 6).astype(float)
    tree = boosting.grow(bins, y, np.ones(500), np.arange(500, dtype=np.uint64), np.zeros(500), 0, boosting.Spec(depth=2, min_leaf=0), 8)
    assert seen == [1, 2]
    at = boosting.reached(tree.feature, 2)[boosting.paths(bins.T, tree.feature, tree.cut, 2)]
    for leaf in np.flatnonzero(tree.feature == -1):
        assert tree.rows[leaf] == (at == leaf).sum() and tree.value[leaf] == pytest.approx(-(0.5 - y[at == leaf]).sum() / (0.25 * (at == leaf).sum()))


def test_terms_of_a_leaf_are_worked_out_once_for_all_batches(monkeypatch, rows):
    model = boosting.model_of(boosting.fit_many(rows, FEATURES, "y", SPECS), 0, "forest", SPECS["forest"])
    seen, plain = [], boosting.shapley_patterns
    monkeypatch.setattr(boosting, "shapley_patterns", lambda z: seen.append(len(z)) or plain(z))
    x = np.array([[0.1, -0.2, 0.3], [float("nan"), 1.0, 2.0]])
    first = model.contributions(x)
    leaves = sum(seen)
    assert leaves == (model.feature == -1).sum() and np.array_equal(first, model.contributions(x)) and sum(seen) == leaves


def test_groups_of_equal_rows_give_the_trees_of_single_rows():
    rng = np.random.default_rng(4)
    n, s = 4000, boosting.Spec(trees=1, depth=3, min_leaf=3, subsample=0.7, l2=1)
    bins, h = rng.integers(0, 5, (3, n)).astype(np.uint8), rng.integers(0, 1 << 62, n).astype(np.uint64)
    y = (rng.random(n) < (1 + bins[0]) / 7).astype(float)
    w = np.where(y == 1, 2.0, 1.0)
    for spec in (s, boosting.Spec(trees=1, depth=4, min_leaf=5, forest=True)):
        kept, labels, weights, hashes, start, learned = boosting.grouped(bins, y, w, h, np.zeros(n, bool))
        assert learned == len(start) == len(labels) <= 2 * 5 ** 3 and sorted(hashes) == sorted(h)
        margin = rng.normal(size=5 ** 3)
        own = lambda b: margin[np.ravel_multi_index(tuple(b.astype(int)), (5, 5, 5))]  # noqa: B023, E731
        one = boosting.grow(bins.T, y, w, h, own(bins), 3, spec, 5)
        many = boosting.grow(kept.T, labels, weights, hashes, own(kept), 3, spec, 5, start)
        assert one.feature.tolist() == many.feature.tolist() and one.cut.tolist() == many.cut.tolist() and (one.feature >= 0).sum() > 2
        assert np.allclose(one.value, many.value) and np.allclose(one.cover, many.cover) and one.rows.tolist() == many.rows.tolist()


def test_draws_are_those_of_the_shares():
    h = np.arange(50_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    share = boosting.shares(h, 5)
    assert (boosting.drawn_weights(h, 5, boosting.Spec(subsample=0.7)) == (share < 0.7)).all()
    steps = np.cumsum([np.exp(-1.0) / factorial(i) for i in range(12)])
    assert (boosting.drawn_weights(h, 5, boosting.Spec(forest=True)) == np.searchsorted(steps, share, "right")).all()


@pytest.mark.parametrize("name", list(SPECS))
def test_cells_between_cuts_are_scored_once(rows, name, monkeypatch):
    model = boosting.model_of(boosting.fit_many(rows, FEATURES, "y", SPECS), 1, name, SPECS[name])
    x = np.random.default_rng(2).normal(size=(3000, 3))
    x[5] = np.nan
    worked_out = []
    sums = boosting.TreeModel._sums
    monkeypatch.setattr(boosting.TreeModel, "_sums", lambda self, bins, values: worked_out.append(bins.shape[1]) or sums(self, bins, values))
    once, again = model.margins(x), model.margins(x)
    assert sum(worked_out) == len(np.unique(model.bins(x), axis=1).T) < 3000
    monkeypatch.setattr(boosting, "SCORE_CELLS", 0)
    assert (once == again).all() and (once == model.margins(x)).all()


def test_a_sigmoid_map_is_a_column_and_agrees_with_the_fitted_model(rows):
    from pyspark.ml.linalg import Vectors
    one = rows.where("_set = 0 and y is not null")
    model = learners.fit_calibrated(one, FEATURES, "y", "logistic_regression", {"C": 0.5, "max_iter": 50}, keys=["id"], method="sigmoid", folds=2)
    scored = model.score(one)
    assert "UDF" not in scored._jdf.queryExecution().executedPlan().toString()
    raw = {r["id"]: r["_raw"] for r in learners.scored(one, model.model, FEATURES, "_raw").collect()}
    for r in scored.orderBy("id").limit(20).collect():
        assert r["pred_prob"] == pytest.approx(model.mapping.predictProbability(Vectors.dense(raw[r["id"]]))[1], abs=1e-12)


def test_permuted_rows_are_scored_once(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    def score(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch.assign(pred_prob=1 / (1 + np.exp(-batch["a"])))

    one = rows.where("_set = 0").select("id", "y", "a", "b")
    scored = lambda df: df.mapInPandas(score, "id long, y int, feature string, a double, b double, pred_prob double")
    found = {r["feature"]: r for r in learners.permutation_importance(one, scored, ["a", "b"], "y", ["id"]).collect()}
    assert seen.value == 3 * one.where("y is not null").count()
    assert found["b"]["importance"] == 0 and found["a"]["importance"] > 0


def test_models_sent_out_hold_what_scores_need(rows):
    found = boosting.fit_many(rows, FEATURES, "y", SPECS)
    whole = boosting.model_of(found, 1, "forest", SPECS["forest"])
    slim = boosting.model_of(found, 1, "forest", SPECS["forest"]).slim()
    x = np.random.default_rng(3).normal(size=(5000, 3))
    assert (whole.probabilities(x) == slim.probabilities(x)).all()
    held = [v for v in vars(slim).values() if isinstance(v, np.ndarray)]
    assert sum(v.nbytes for v in held) == boosting.SLIM_BYTES * slim.value.size


def test_linear_steps_read_blocks_and_both_ways_of_adding_up_agree(rows, monkeypatch):
    kept, plain = [], linear.settled
    monkeypatch.setattr(linear, "settled", lambda df: kept.append(plain(df)) or kept[-1])
    of = {"c1": {"C": 0.5, "max_iter": 50}}
    found = linear.fit_linear(rows.coalesce(1), FEATURES, "y", of)
    assert kept[0].count() == 2 and sum(len(r["_y"]) // 8 for r in kept[0].collect()) == rows.where("y is not null").count()
    monkeypatch.setattr(linear, "SUMS_BYTES", 0)
    monkeypatch.setattr(linear, "WAITING_ROWS", 1)
    spread = linear.fit_linear(rows, FEATURES, "y", of)
    assert set(found) == set(spread) and all(np.allclose(found[k].weights, spread[k].weights, atol=1e-9) for k in found)


def test_both_kinds_of_trees_share_their_cut_points_and_models_lie_in_few_parts(spark, rows, monkeypatch):
    seen, plain = [], boosting.cut_points
    counted = lambda *a: seen.append(1) or plain(*a)
    monkeypatch.setattr(boosting, "cut_points", counted)
    monkeypatch.setattr(learners, "cut_points", counted, raising=False)
    models = learners.fit_trees(rows.drop("weight", "_aside", "_spot"), FEATURES, "y", SPECS, strategy="scale_weight", keys=["id"])
    assert sum(seen) == 1 and models.count() == 4
    assert models.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism


def test_gains_are_those_of_the_leaf_weights():
    rng = np.random.default_rng(6)
    g, h = rng.normal(size=500) * 5, np.concatenate([np.zeros(5), rng.random(495) * 4])
    for s in (boosting.Spec(), boosting.Spec(l1=1.0, l2=2.0), boosting.Spec(l1=0.5, max_step=0.3), boosting.Spec(l2=1.0, max_step=2.0)):
        w = boosting.leaf_weight(g, h, s)
        assert np.allclose(boosting.leaf_gain(g, h, s)[5:], -(2 * g * w + (h + s.l2) * w * w + 2 * s.l1 * np.abs(w))[5:])
