"""Order statistics, metrics, drift and routing against brute force, and their laws."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewarden import vocabulary as v
from scorewarden.operators import drift, learners, metrics, ordering, routing, splits


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def mixed(spark):
    """Group 'a' holds most rows, half of them one value; 'c' has one class, a null group exists too."""
    rng = random.Random(3)
    rows = [("a", float(rng.choice([7.0, rng.random() * 9])), rng.randint(0, 1)) for _ in range(600)]
    rows += [("b", float(rng.randint(0, 3)), rng.randint(0, 1)) for _ in range(40)]
    rows += [("c", rng.random(), 1) for _ in range(5)] + [(None, rng.random(), rng.randint(0, 1)) for _ in range(30)]
    return rows, frame(spark, rows, "g string, x double, y int").cache()


def by_group(rows):
    groups = {}
    for g, x, y in rows:
        groups.setdefault(g, []).append((x, y))
    return groups


@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
def test_exact_quantiles_equal_numpy(mixed, buckets):
    rows, df = mixed
    shares = [0, 0.1, 0.25, 0.5, 0.9, 1]
    got = {r["g"]: r["quantiles"] for r in ordering.exact_quantiles(df, "x", shares, ["g"], buckets).collect()}
    for g, pairs in by_group(rows).items():
        assert np.allclose(got[g], np.quantile([x for x, _ in pairs], shares), rtol=0, atol=1e-12)


@pytest.mark.parametrize("buckets", [1, 5, 64])
def test_running_totals_equal_brute_force(mixed, buckets):
    rows, df = mixed
    got = ordering.running_totals(df, "x", {"n": F.lit(1), "s": F.col("y")}, ["g"], buckets).collect()
    groups = by_group(rows)
    assert len(got) == sum(len({x for x, _ in p}) for p in groups.values())
    for r in got:
        pairs = groups[r["g"]]
        assert r["n_before"] == sum(x < r["x"] for x, _ in pairs) and r["n_all"] == len(pairs)
        assert r["s_before"] == sum(y for x, y in pairs if x < r["x"])


def brute_auc(pairs):
    pos, neg = [x for x, y in pairs if y], [x for x, y in pairs if not y]
    if not pos or not neg:
        return 0.0
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / len(pos) / len(neg)


def test_metrics_equal_brute_force_per_group(mixed):
    rows, df = mixed
    got = {r["g"]: r for r in metrics.classification_metrics(df, "y", "x", ["g"], 2.0).collect()}
    for g, pairs in by_group(rows).items():
        r, n = got[g], len(pairs)
        pos = sum(y for _, y in pairs)
        assert r["rows"] == n and r["auc"] == pytest.approx(brute_auc(pairs))
        assert r["brier_score"] == pytest.approx(sum((x - y) ** 2 for x, y in pairs) / n)
        assert r["true_positive"] == sum(x >= 2 and y for x, y in pairs)
        assert r["true_negative"] == sum(x < 2 and not y for x, y in pairs)
        if 0 < pos < n:
            gap = max(abs(sum(a <= x and y for a, y in pairs) / pos - sum(a <= x and not y for a, y in pairs) / (n - pos)) for x, _ in pairs)
            assert r["ks"] == pytest.approx(gap)
        else:
            assert r["ks"] == 0 and r["auc"] == 0


def test_auc_laws(mixed):
    _, df = mixed
    auc = lambda e: metrics.classification_metrics(df.withColumn("x", e), "y", "x").first()["auc"]
    base = auc(F.col("x"))
    assert auc(F.exp("x") * 3) == pytest.approx(base)
    assert auc(-F.col("x")) == pytest.approx(1 - base)


def test_empty_input_gives_no_rows(spark):
    empty = spark.createDataFrame([], "g string, x double, y int")
    assert metrics.classification_metrics(empty, "y", "x", ["g"]).count() == 0
    assert ordering.exact_quantiles(empty, "x", [0.5], ["g"]).count() == 0


def brute_psi(expected, actual):
    bins = np.percentile(expected, np.linspace(0, 100, 11))
    bins[0], bins[-1] = -np.inf, np.inf
    bins = np.unique(bins)
    e, a = (np.histogram(x, bins)[0] / len(x) for x in (expected, actual))
    e, a = np.maximum(e, 1e-10), np.maximum(a, 1e-10)
    return float(np.sum((a - e) * np.log(a / e)))


def test_numeric_psi_equals_numpy_with_ties_and_outside_values(spark):
    rng = np.random.default_rng(5)
    dev = {"u": rng.normal(size=500), "t": rng.integers(0, 4, 500).astype(float)}
    oot = {"u": rng.normal(0.5, 2, size=300), "t": rng.integers(-1, 5, 300).astype(float)}
    rows = [(True, float(u), float(t)) for u, t in zip(dev["u"], dev["t"])] + [(False, float(u), float(t)) for u, t in zip(oot["u"], oot["t"])]
    df = frame(spark, rows, "ref boolean, u double, t double")
    got = {r["feature"]: r["psi"] for r in drift.numeric_psi(df, ["u", "t"], "ref").collect()}
    for f in ("u", "t"):
        assert got[f] == pytest.approx(brute_psi(dev[f], oot[f]))


def test_psi_is_zero_on_itself_and_never_negative(mixed):
    _, df = mixed
    twice = df.withColumn("ref", F.lit(True)).unionByName(df.withColumn("ref", F.lit(False)))
    assert drift.numeric_psi(twice, ["x"], "ref").first()["psi"] == pytest.approx(0)
    assert drift.category_psi(twice, ["g"], "ref").first()["psi"] == pytest.approx(0)
    assert drift.smoothed_psi(twice, ["x"], "ref").first()["psi"] == pytest.approx(0)
    half = df.withColumn("ref", F.col("x") < 3)
    assert all(r["psi"] >= 0 for r in drift.numeric_psi(half, ["x"], "ref").collect())


def test_constant_column_has_no_smoothed_psi(spark):
    df = frame(spark, [(True, 1.0), (False, 1.0)], "ref boolean, x double")
    assert drift.smoothed_psi(df, ["x"], "ref").first()["psi"] == 0.0


def test_zone_edges_and_empty_zones(spark):
    df = frame(spark, [(0.5, 1), (0.85, 1), (0.49, 0), (float("nan"), 0)], "p double, y int")
    zones = {r["p"]: r["pred_zone"] for r in routing.assign_zones(df, "p", 0.5, 0.85, v.ZONE_NAMES).collect() if not math.isnan(r["p"])}
    assert zones == {0.5: 1, 0.85: 2, 0.49: 0}
    crossed = routing.assign_zones(df.where("p = 0.5"), "p", 0.6, 0.4, v.ZONE_NAMES).first()
    assert crossed["pred_zone"] == 0
    summary = routing.zone_summary(df.where("p >= 0.85 and not isnan(p)"), "y", "p", 0.5, 0.85, v.ZONE_NAMES).collect()
    assert sorted((r["zone"], r["count"], r["actual_reject_rate"]) for r in summary) == [(0, 0, 0.0), (1, 0, 0.0), (2, 1, 0.0)]
    assert sum(r["ratio"] for r in summary) == pytest.approx(1)


def test_grid_row_equals_zone_summary(mixed):
    _, df = mixed
    df = df.withColumn("x", F.col("x") / 9)
    grid = {(r["lower_threshold"], r["upper_threshold"]): r for r in routing.threshold_grid(df, "y", "x", v.LOWER_GRID, v.UPPER_GRID).collect()}
    assert len(grid) == 27
    row = grid[(0.4, 0.85)]
    zones = {r["zone"]: r for r in routing.zone_summary(df, "y", "x", 0.4, 0.85, v.ZONE_NAMES).collect()}
    assert (row["high_zone_count"], row["review_zone_count"], row["low_zone_count"]) == tuple(zones[z]["count"] for z in (2, 1, 0))
    assert row["expected_precision_low"] == pytest.approx(zones[0]["actual_reject_rate"])
    assert len(routing.grid_pairs(v.LOWER_GRID, v.UPPER_GRID, v.MIN_GRID_GAP)) == 22


def test_policy_falls_back_to_the_defaults(spark):
    empty = routing.score_policies(routing.threshold_grid(
        spark.createDataFrame([], "p double, y int"), "y", "p", v.LOWER_GRID, v.UPPER_GRID), v.POLICY)
    row = routing.choose_policy(empty, 0.5, 0.85).first()
    assert (row["lower_threshold"], row["upper_threshold"], row["threshold_source"]) == (0.5, 0.85, "default")


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 31])
def test_two_thirds_split_on_one_hot_day(spark, n):
    rows = [(i, "2024-01-02" if i % 3 else "2024-01-01") for i in range(n)]
    df = frame(spark, rows, "id bigint, d string").withColumn("d", F.to_date("d"))
    got = {r["id"]: r["split"] for r in splits.two_thirds_split(df, "d", "id").collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    want = {i: "policy" if k < (2 * n) // 3 else "holdout" for k, (i, _) in enumerate(order)}
    assert got == want


def test_default_calendar_has_seven_windows(spark):
    rows = splits.rolling_windows(spark, v.DATA_START, v.OOT_START).orderBy("window_id").collect()
    assert len(rows) == 7
    assert [str(x) for x in rows[-1][1:]] == ["2025-04-01", "2025-07-31", "2025-08-01", "2025-09-30"]


def test_windows_that_start_mid_month(spark):
    windows = splits.typed_windows(spark.createDataFrame(
        [("1", "2024-01-15", "2024-02-14", "2024-02-15", "2024-03-14")],
        "window_id string, train_start string, train_end string, monitor_start string, monitor_end string"))
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-03-31')) as d")
    got = {r["phase"]: r["n"] for r in splits.tag_windows(days, windows, "d").groupBy("phase").agg(F.count("*").alias("n")).collect()}
    assert got == {"train": 31, "monitor": 29}


def test_hash_choice_is_exact_and_repeatable(spark):
    df = spark.range(1000)
    first, second = (sorted(r["id"] for r in ordering.smallest_by_hash(df.repartition(k), ["id"], "137").collect()) for k in (2, 5))
    assert len(first) == 137 and first == second


def test_oversampling_balances_and_stays_between_neighbours(spark):
    rows = [(i, 1, float(i % 7), 1.0) for i in range(200)] + [(1000 + i, 0, 5.0, 5.0) for i in range(40)] + [(2000 + i, 0, 5.0 + i / 10, 6.0) for i in range(10)]
    df = frame(spark, rows, "id bigint, y int, a double, b double")
    made = learners.oversampled(df, "y", ["id"], ["a", "b"])
    counts = {r["y"]: r["count"] for r in made.groupBy("y").count().collect()}
    assert counts == {0: 200, 1: 200}
    new = made.where("is_synthetic").agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    assert new[0] >= 5 and new[1] <= 5.9 and new[2] >= 5 and new[3] <= 6
