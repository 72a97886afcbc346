"""Rows that fits and scores cannot tell apart are counted first: the same figures as of single rows, and draws of the same law."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewarden import vocabulary as v
from scorewarden.operators import boosting, learners, linear, metrics, routing
from scorewarden.operators.splits import rolling_windows

FEATURES = ["a", "b"]
SPECS = {
    "boosted": boosting.Spec(trees=6, depth=3, rate=0.3, min_leaf=2, subsample=0.7, l2=1, patience=4),
    "forest": boosting.Spec(trees=3, depth=3, min_leaf=5, forest=True)}


@pytest.fixture(scope="module")
def rows(spark):
    """Each of 300 rows 40 times, with keys of its own."""
    rng = np.random.default_rng(0)
    made = [(i, *map(float, x), int(rng.random() < 1 / (1 + np.exp(-2 * x[0])))) for i, x in enumerate(rng.normal(size=(300, 2)).round(1))]
    made += [(300, None, float("nan"), 1)]
    one = spark.createDataFrame(made, "one long, a double, b double, y int")
    return one.withColumn("time", F.explode(F.sequence(F.lit(0), F.lit(39)))).withColumn("id", F.col("one") * 100 + F.col("time")).withColumns({
        "_set": F.lit(0), "weight": F.lit(1.0), "_aside": F.pmod(F.xxhash64("id"), F.lit(7)) == 0, "_spot": F.xxhash64("id")}).cache()


def test_a_fit_takes_cells_however_often_their_rows_repeat(rows, monkeypatch):
    kept, plain = [], boosting.settled
    monkeypatch.setattr(boosting, "settled", lambda df: kept.append(plain(df)) or kept[-1])
    models_ = boosting.fit_many(rows, FEATURES, "y", SPECS)
    distinct = rows.fillna(0.0).select("a", "b", "y", "_aside").distinct().count()
    blocks = kept[0].collect()
    assert sum(len(r["_y"]) for r in blocks) <= distinct < rows.count() / 15
    assert sum(int(np.frombuffer(r["_h"], np.uint64).reshape(-1, 2)[:, 1].sum()) for r in blocks) == rows.count()
    spread = boosting.fit_many(rows.repartition(7), FEATURES, "y", SPECS, task_bytes=1)
    for one, other in zip(models_.orderBy("_candidate").collect(), spread.orderBy("_candidate").collect(), strict=True):
        assert one["feature"] == other["feature"] and one["cut"] == other["cut"] and max(one["feature"]) >= 0
        assert np.allclose(one["value"], other["value"]) and np.allclose(one["rows"], other["rows"])


@pytest.mark.parametrize("n", [1, 2, 63, 64, 200, 5000])
@pytest.mark.parametrize("spec", [boosting.Spec(subsample=0.7), boosting.Spec(subsample=0.05), boosting.Spec(forest=True)])
def test_draws_of_a_cell_have_the_law_of_single_draws(n, spec):
    size = 40_000
    h = np.random.default_rng(n).integers(0, 1 << 62, size).astype(np.uint64)
    got = boosting.drawn_sums(h, np.full(size, n), 3, spec)
    mean, var = (n, n) if spec.forest else (n * spec.subsample, n * spec.subsample * (1 - spec.subsample))
    assert got.min() >= 0 and (spec.forest or got.max() <= n)
    assert abs(got.mean() - mean) < 5 * np.sqrt(var / size) and abs(got.var() / var - 1) < 0.06
    single = boosting.drawn_weights(np.random.default_rng(1).integers(0, 1 << 62, size * min(n, 20)).astype(np.uint64), 3, spec).reshape(size, -1).sum(1)
    if n <= 20:  # shares of each number, against draws row by row
        top = max(got.max(), single.max()) + 1
        assert np.abs(np.bincount(got, minlength=top) - np.bincount(single, minlength=top)).max() < 6 * np.sqrt(size / 2)
    if n == 1:
        assert (got == boosting.drawn_weights(h, 3, spec)).all()


def test_mixed_cells_keep_their_numbers():
    rng = np.random.default_rng(2)
    n = rng.integers(1, 400_000, 3000)
    h = rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    for spec in (boosting.Spec(subsample=0.6), boosting.Spec(forest=True)):
        got, share = boosting.drawn_sums(h, n, 1, spec), 1 if spec.forest else 0.6
        far = np.abs(got - share * n) / np.sqrt(n * (1 if spec.forest else 0.24))
        assert far.max() < 6 and abs((far ** 2).mean() - 1) < 0.15
    assert (boosting.drawn_sums(h, n, 1, boosting.Spec()) == n).all()


def test_cells_are_scored_like_their_rows(rows):
    found = boosting.fit_many(rows, FEATURES, "y", SPECS)
    cuts = boosting.cuts_of(found, 2)
    cells = boosting.counted(rows, FEATURES, cuts, ["_set", "y"])
    scores = lambda df, keep: boosting.score_many(df, found, FEATURES, SPECS, keep)
    own = scores(rows, ["y"]).groupBy("_candidate", "y", "pred_prob").count().collect()
    held = scores(cells, ["y", "_n"]).groupBy("_candidate", "y", "pred_prob").agg(F.sum("_n").alias("count")).collect()
    assert sorted(own) == sorted(held) and cells.count() < rows.count() / 15
    at_cuts = boosting.counted(rows.select(F.lit(0).alias("_set"), F.lit(float(cuts[0][0])).alias("a"), "b"), FEATURES, cuts, ["_set"]).select("a").distinct()
    assert [r["a"] <= cuts[0][0] for r in at_cuts.collect()] == [True]
    ends = rows.sparkSession.createDataFrame([(float("inf"), 0.0), (float("-inf"), 0.0)], "a double, b double").withColumn("_set", F.lit(0))
    assert boosting.counted(ends, FEATURES, cuts, ["_set"]).count() == 2


def test_figures_of_counted_scores_are_those_of_their_rows(spark):
    rng = np.random.default_rng(3)
    one = spark.createDataFrame([(i % 2, int(rng.random() < p), float(round(p, 2)), int(rng.integers(1, 9))) for i, p in enumerate(rng.random(400))], "g int, y int, p double, n int")
    many = one.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("n", "i")
    for f in (lambda df, **k: metrics.classification_metrics(df, "y", "p", ["g"], **k),
              lambda df, **k: routing.threshold_grid(df, "y", "p", v.LOWER_GRID, v.UPPER_GRID, ["g"], **k),
              lambda df, **k: routing.routing_kpis(df, "y", "p", 0.3, 0.7, ["g"], **k),
              lambda df, **k: learners.calibration_cells(df, "y", "p", **k)):
        got, want = (sorted(map(tuple, df.collect())) for df in (f(one, count="n"), f(many)))
        assert len(got) == len(want) and all(a == pytest.approx(b) for a, b in zip(got, want, strict=True))


def test_windows_keep_each_row_once_and_their_figures_are_those_of_the_rows(spark, rows, monkeypatch):
    dated = rows.drop("_set", "weight", "_aside", "_spot").withColumn("day", F.expr("date_add(date'2000-01-01', int(id % 360))")).cache()
    windows = rolling_windows(spark, dt.date(2000, 1, 1), dt.date(2000, 12, 28))
    assert windows.count() >= 3
    kept, plain = [], learners.settled
    monkeypatch.setattr(learners, "settled", lambda df: kept.append(plain(df)) or kept[-1])
    of = {"boosted": ("boosted_trees", {"trees": 3, "depth": 2, "rate": 0.3}), "line": ("logistic_regression", {"C": 0.5, "max_iter": 20})}
    cycles = learners.rolling_cycles(dated, windows, day="day", label="y", keys=["id"], features=FEATURES, candidates=of).collect()
    assert len(cycles) == 2 * windows.count() and max(df.count() for df in kept) <= dated.count()
    counted = next(df for df in kept if "_n" in df.columns)
    for r in cycles[:2]:
        own = counted.where((F.col("window_id") == r["window_id"]) & (F.col("model_name") == r["model_name"]) & (F.col("phase") == "monitor")).collect()
        p, n = (np.array([x[c] for x in own], float) for c in ("pred_prob", "_n"))
        inside = windows.where(F.col("window_id") == r["window_id"]).first()
        assert n.sum() == r["monitor_rows"] == dated.where(F.col("day").between(inside["monitor_start"], inside["monitor_end"])).count()
        assert r["monitor_score_mean"] == pytest.approx((n * p).sum() / n.sum())
        assert r["monitor_score_std"] == pytest.approx(np.sqrt((n * (p - (n * p).sum() / n.sum()) ** 2).sum() / n.sum()))


def test_judged_rows_are_cells_for_trees_and_rows_for_lines(rows):
    tree = boosting.model_of(boosting.fit_many(rows, FEATURES, "y", SPECS), 0, "boosted", SPECS["boosted"])
    line = linear.LinearModel([1.0, 0.5, 0.1])
    of = lambda m: learners.Calibrated(m, None, FEATURES)
    cells = learners.judged_cells(rows, [of(tree)], FEATURES, ["y"])
    assert cells.agg(F.sum("_n")).first()[0] == rows.count() > 15 * cells.count()
    assert learners.judged_cells(rows, [of(tree), of(line)], FEATURES, ["y"]).count() == rows.count()


def test_linear_scores_are_sums_of_columns(rows):
    found = {(0, "line"): linear.LinearModel([1.0, 0.5, 0.1])}
    scores = linear.score_linear(rows, found, FEATURES, ["id"])
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "zip_with" not in plan and "lambda" not in plan
    want = {r["id"]: r["p"] for r in rows.select("id", found[0, "line"].probability(FEATURES).alias("p")).collect()}
    assert all(r["pred_prob"] == pytest.approx(want[r["id"]], abs=1e-15) for r in scores.collect())
