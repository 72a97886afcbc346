"""The decision-tuned challengers are judged together: the figures of one after another, in as many jobs whatever their number."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewarden.operators import learners, linear, metrics, routing
from scorewarden.plans import challengers, training

FEATURES = ["a", "b"]


def test_challengers_are_judged_in_the_same_jobs(spark, monkeypatch):
    rng = np.random.default_rng(0)
    made = [(i, float(a), float(b), int(rng.random() < 1 / (1 + np.exp(-2 * a)))) for i, (a, b) in enumerate(rng.normal(size=(1500, 2)))]
    rows = spark.createDataFrame(made, "id long, a double, b double, y int").cache()
    policy, holdout = rows.where("id % 3 = 0"), rows.where("id % 3 = 1")
    setup = training.Setup(day="day", label="y", keys=["id"], features=FEATURES, tie="id")
    models = {c: {m: learners.Calibrated(linear.LinearModel([w, 0.1 * len(m), 0.2]), None, FEATURES) for m in ("isotonic", "sigmoid")} for c, w in (("one", 1.0), ("two", 2.0), ("three", -0.5))}
    cycles = spark.createDataFrame([(w, c, *[0.5 + 0.01 * w] * 5) for w in (1, 2) for c in models], "window_id int, model_name string, " + ", ".join(
        f"{n} double" for n in ("train_auc", "monitor_auc", "monitor_f1_reject", "monitor_ks", "monitor_brier")))
    base = challengers.holdout_figures(holdout.select(F.col("y").alias("actual_label"), F.lit(0.6).alias("pred_prob"), F.lit(1).alias("pred_zone")), "baseline")
    monkeypatch.setattr(challengers, "evaluate_candidates", lambda *a, **k: cycles)
    jobs, plain = [], challengers.settled

    def run(names):
        monkeypatch.setattr(challengers, "retrain_methods", lambda *a: {c: models[c] for c in names})
        monkeypatch.setattr(challengers, "settled", lambda df: jobs[-1].append(1) or plain(df))
        jobs.append([])
        return challengers.decision_tuning_challenger(rows, policy, holdout, None, setup, base, [(c, "logistic_regression", {}) for c in names])

    run(["one"])
    found = run(list(models))
    assert len(jobs[0]) == len(jobs[1])
    have = {(r["config_id"], r["calibration_method"]): r for r in found["candidates"].collect()}
    assert len(have) == 6 and found["decision"].count() == 6
    for (c, m), r in have.items():
        grid, pair = training.choose_thresholds(models[c][m].score(policy), setup)
        held = models[c][m].score(holdout)
        zones = routing.routing_kpis(held, "y", "pred_prob", pair["lower_threshold"], pair["upper_threshold"]).first().asDict()
        test = metrics.classification_metrics(held, "y", "pred_prob").first()
        assert (r["best_lower_threshold"], r["best_upper_threshold"]) == (pair["lower_threshold"], pair["upper_threshold"])
        assert all(r[n] == pytest.approx(x) for n, x in zones.items() if n != "n")
        assert r["holdout_auc"] == pytest.approx(test["auc"]) and r["holdout_ks"] == pytest.approx(test["ks"]) and r["recall_reject"] == pytest.approx(test["recall_reject"])
        assert r["train_brier"] == pytest.approx(metrics.classification_metrics(models[c][m].score(rows), "y", "pred_prob").first()["brier_score"])
        own = found["threshold_policies"].where((F.col("config_id") == c) & (F.col("calibration_method") == m))
        assert own.count() == grid.count()
