"""The jobs end to end on files: raw text to gold, training, challengers, monitoring, diagnosis."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalog.base import raw_applications
from scorewarden import vocabulary as v
from scorewarden.operators import encoders, features, splits
from scorewarden.operators.learners import tree_importance
from scorewarden.plans import challengers, layers, training, watch
from scorewarden.sources import readers, writers
from scorewarden.storage import left_lookup
from tests.conftest import SMALL

OOT = dt.date(2000, 1, 1)


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    # one case per order, so that enough rows remain to train on
    raw = raw_applications(spark, SMALL).withColumn("案件編號", F.monotonically_increasing_id().cast("string"))
    raw.coalesce(2).write.option("header", True).csv(f"{root}/raw")
    assert layers.run_bronze(spark, f"{root}/raw", f"{root}/bronze") == raw.count()
    layers.run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/reports", "r1")
    paths = layers.run_gold(spark, f"{root}/silver", f"{root}/gold", "r1", data_start=dt.date(1995, 1, 1), oot_start=OOT)
    return root, paths


def test_rows_are_counted_by_the_job_that_writes_them(spark, tmp_path):
    source = spark.read.parquet(f"{SMALL}/orders.parquet")
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        rows = writers.write_counted(source.select("o_orderkey"), f"{tmp_path}/all")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows == source.count() and len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) == 1
    shuffled = source.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"))
    assert writers.write_counted(shuffled, f"{tmp_path}/grouped") == shuffled.count()
    assert writers.write_counted(source.where("o_orderkey < 0"), f"{tmp_path}/grouped") == 0
    assert writers.write_counted(source.limit(0), f"{tmp_path}/none") == 0
    assert spark.read.parquet(f"{tmp_path}/grouped").count() == 0


def test_layers_and_reports(spark, gold):
    root, paths = gold
    bronze = readers.read_table(spark, f"{root}/bronze")
    assert {t for c, t in bronze.dtypes if c != "bronze_load_timestamp"} == {"string"}
    audit = readers.read_table(spark, f"{root}/reports/audit").first()
    silver = readers.read_table(spark, f"{root}/silver")
    assert audit["rows_before"] == bronze.count() and audit["rows_after"] == silver.count()
    assert sum(audit["drop_reasons"].values()) == audit["rows_dropped"]
    development, oot = (readers.read_table(spark, paths[p]) for p in ("development", "oot"))
    assert development.count() + oot.count() == silver.count()
    assert development.agg(F.max(v.DAY)).first()[0] < OOT <= oot.agg(F.min(v.DAY)).first()[0]
    names = features.model_columns(development, v.NON_FEATURES)
    assert len(names) == 25 and len(features.model_columns(development, v.NON_FEATURES, v.PRUNED_FEATURES)) == 19
    for report in ("drift", "unseen", "number_statistics", "level_statistics", "validation", "audit"):
        assert readers.read_table(spark, f"{paths['reports']}/{report}").count() > 0


def test_date_range_reads_prune_months(spark, gold):
    df = readers.read_between(spark, gold[1]["development"], v.DAY, v.MONTH, dt.date(1996, 1, 15), dt.date(1996, 3, 10))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "1996-01" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert {r[0] for r in df.select(v.MONTH).distinct().collect()} <= {"1996-01", "1996-02", "1996-03"}


def test_encoders_survive_a_round_trip(spark, gold):
    _, paths = gold
    names = ["scaler", "frequency", "ordinal", "features", "summary"]
    back = readers.read_table(spark, f"{paths['encoders']}/features")
    assert back.count() == 26
    loaded = writers.read_encoders(spark, paths["encoders"], names)
    silver = layers.split_table(readers.read_table(spark, f"{gold[0]}/silver"), OOT)
    again = encoders.fit_frequency(silver.where("split = 'development'"), v.HIGH_CARDINALITY)
    assert again.exceptAll(loaded["frequency"].select(again.columns)).count() == 0
    writers.write_frequency_csv(loaded["frequency"], f"{gold[0]}/review")
    text = readers.read_result_csv(spark, f"{gold[0]}/review", "value string, freq double, unseen double")
    assert text.count() == loaded["frequency"].count()


def test_a_large_lookup_table_is_joined_by_key_but_for_hot_ones(spark):
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 != 0, F.col("id"))
    rows = spark.range(3000).select(key.alias("k"), "id")
    shares = rows.groupBy("k").agg((F.count("*") / 3000).alias("w"))
    table = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x")).join(shares, "k", "left").fillna(0, ["w"])
    small, large = (left_lookup(rows, table, ["k"], weight="w", max_bytes=m, hot_share=100) for m in (1 << 20, 10))
    assert sorted(map(tuple, small.select("k", "id", "x").collect()), key=str) == sorted(map(tuple, large.select("k", "id", "x").collect()), key=str)
    assert small.columns == large.columns and large.count() == 3000
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 3 and plan.count("strategy=broadcast") == 2


@pytest.fixture(scope="module")
def trained(spark, gold):
    development, oot = (readers.read_table(spark, gold[1][p]) for p in ("development", "oot"))
    names = ["年齡_scaled", "原申辦金額_log_scaled", "教育程度_序位", "性別_二元"]
    setup = training.Setup(
        day=v.DAY, label=v.LABEL, keys=[v.CASE], features=names, tie=v.CASE, month=v.MONTH, folds=2, cv_splits=1,
        candidates={"random_forest": ("random_forest", {"trees": 3, "depth": 3, "min_leaf": 5})})
    windows = splits.rolling_windows(spark, dt.date(1995, 1, 1), OOT, 24, 12, 24)
    return development, oot, windows, setup, training.run_training(development, oot, windows, setup)


def test_training_results_are_complete(spark, gold, trained):
    results = trained[4]
    paths = writers.write_results(results, f"{gold[0]}/results", "r1")
    assert set(paths) == set(results)
    stages = {r["stage"]: r for r in writers.read_results(spark, f"{gold[0]}/results", "stage_metrics").collect()}
    assert set(stages) == {"train", "policy", "holdout"}
    labelled = trained[1].where(F.col(v.LABEL).isNotNull()).count()
    assert (stages["policy"]["rows"], stages["holdout"]["rows"]) == ((2 * labelled) // 3, labelled - (2 * labelled) // 3)
    assert results["rolling_results"].count() == 2 and results["threshold_policies"].count() == 27
    predictions = results["holdout_predictions"]
    assert predictions.where("pred_prob < 0 or pred_prob > 1 or pred_prob is null").count() == 0
    row = results["diagnostics"].first()
    assert row["gap_train_vs_holdout_auc"] == pytest.approx(row["train_auc"] - row["final_holdout_auc"])


def test_monitoring_and_diagnosis_jobs(spark, gold, trained):
    development, oot, windows, setup, results = trained
    out = f"{gold[0]}/watch"
    rows = watch.run_monitoring(results["holdout_predictions"], results["policy_predictions"], out, label="actual_label",
                                trained_on=dt.date(2001, 1, 1), today=dt.date(2001, 8, 1))
    assert rows.first()["needs_retraining"]
    decision = readers.read_table(spark, f"{out}/retraining_decisions").first()
    assert decision["development_start"] == "1999-08-01" and "Time: 7 months" in decision["retraining_trigger_reason"]
    whole = development.withColumn("dev", F.lit(True)).unionByName(oot.withColumn("dev", F.lit(False)))
    gains = spark.createDataFrame([(f, float(i), 1.0) for i, f in enumerate(setup.features)], "feature string, gain double, weight double")
    found = watch.diagnose(whole, results["holdout_predictions"], gains, windows, key=v.CASE, day=v.DAY, label=v.LABEL, names=setup.features,
                           reference="dev", levels=v.SEGMENT_LEVELS, numbers=v.SEGMENT_NUMBERS)
    assert found["feature_diagnosis"].count() == len(setup.features)
    assert found["counts"].first()["rows"] == results["holdout_predictions"].count()
    evidence = challengers.evidence(results["holdout_predictions"])
    assert evidence["confusion"].count() == 1 and evidence["zone_outcomes"].count() >= 1


def test_batch_scoring_needs_no_label(spark, trained):
    development, oot, _, setup, _ = trained
    model = training.retrain(development, setup, "random_forest", "isotonic")
    batch = watch.score_batch(oot.drop(v.LABEL), model, [v.CASE], "m1", 0.5, 0.85)
    assert batch.count() == oot.count() and batch.where("zone_name is null").count() == 0
    assert tree_importance(model.model, setup.features, oot).count() == len(setup.features)
