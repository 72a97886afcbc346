"""Rules that the driver's tables do not reach: odd keys, missing days, NaN, retries, and results that ignore the cluster."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from scorewarden.operators import contract, drift, features, learners, metrics, splits
from scorewarden.operators.ordering import numbered
from scorewarden.sources import writers


def counted(df):
    return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}


@pytest.mark.parametrize("key", ["id + shiftleft(1L, 60)", "concat('case-', id)", "if(id > 0, id, null)"])
def test_two_thirds_of_one_day_for_any_key(spark, key):
    rows = spark.range(300).select(F.expr(key).alias("k"), F.lit(dt.date(2001, 1, 1)).alias("day"))
    assert counted(splits.two_thirds_split(rows, "day", "k")) == {"policy": 200, "holdout": 100}


def test_large_keys_decide_ties_in_their_order(spark):
    rows = spark.range(300).select((F.col("id") - 150 + (1 << 60)).alias("k"), F.lit(dt.date(2001, 1, 1)).alias("day"))
    last = splits.two_thirds_split(rows, "day", "k").where("split = 'policy'").agg(F.max("k")).first()[0]
    assert last == 199 - 150 + (1 << 60)


def test_rows_without_a_day_count_and_come_last(spark):
    day = F.when(F.col("id") >= 50, F.date_add(F.lit(dt.date(2001, 1, 1)), F.col("id").cast("int")))
    split = splits.two_thirds_split(spark.range(300).select("id", day.alias("day")), "day", "id")
    assert counted(split) == {"policy": 200, "holdout": 100}
    assert split.where("day is null and split = 'policy'").count() == 0


def test_nan_scores_take_no_part(spark):
    rows = spark.createDataFrame([(1, math.nan), (0, 0.2), (1, 0.7), (0, 0.4)], "y int, p double")
    found = metrics.classification_metrics(rows, "y", "p").first()
    assert (found["rows"], found["auc"]) == (3, 1.0) and not math.isnan(found["brier_score"])
    row = drift.score_distribution(rows, "p").first()
    assert (row["n"], row["n_nan"], row["max"], row["median"]) == (3, 1, 0.7, 0.4)


def test_class_texts_are_plain_text(spark):
    names = spark.createDataFrame([("a.b_x",), ("axb",)], "name string")
    assert {r["name"]: r["c"] for r in features.classify_features(names, "name", [(["a.b"], "dotted")], "c").collect()} == {"a.b_x": "dotted", "axb": "other"}


def test_warnings_keep_a_row_valid(spark):
    row = contract.unexpected_columns(spark.range(1).withColumn("extra", F.lit(1)), ["id"]).first()
    assert (row["code"], row["severity"], row["is_valid"]) == ("SCH003", "WARNING", True)
    assert contract.required_columns(spark.range(1), ["x"]).first()["is_valid"] is False


def test_a_retry_replaces_its_report_and_run_ids_stay_text(spark, tmp_path):
    for _ in range(2):
        for run in ("007", "8"):
            writers.write_report(spark.range(3), f"{tmp_path}/audit", run, "gold")
    found = writers.read_results(spark, str(tmp_path), "audit")
    assert sorted((r["run_id"], r["part"]) for r in found.select("run_id", "part").collect()) == [("007", "gold")] * 3 + [("8", "gold")] * 3


def skewed(spark, few=40, many=400):
    rows = spark.range(few + many).select("id", (F.col("id") < few).cast("int").alias("y"))
    return rows.withColumns({"a": F.rand(3), "b": F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.rand(4))}).cache()


def test_synthetic_rows_do_not_depend_on_the_cluster(spark):
    rows, found = skewed(spark), []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("4", "90"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        made = learners.oversampled(rows, "y", ["id"], ["a", "b"]).where("is_synthetic")
        found.append(sorted((round(r["a"], 12), round(r["b"], 12)) for r in made.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and len(found[0]) == 360


def test_synthetic_rows_lie_between_two_minority_rows(spark):
    rows = skewed(spark)
    points = [(r["a"], r["b"]) for r in rows.where("y = 1").collect()]
    for r in learners.oversampled(rows, "y", ["id"], ["a", "b"]).where("is_synthetic").collect():
        assert any(
            abs((q[0] - p[0]) * (r["b"] - p[1]) - (q[1] - p[1]) * (r["a"] - p[0])) < 1e-9
            and min(p[0], q[0]) - 1e-9 <= r["a"] <= max(p[0], q[0]) + 1e-9
            for p in points for q in points)


def test_a_single_minority_row_is_repeated(spark):
    made = learners.oversampled(skewed(spark, few=1), "y", ["id"], ["a", "b"])
    assert {(r["y"], r["is_synthetic"]): r["count"] for r in made.groupBy("y", "is_synthetic").count().collect()} == {
        (0, False): 400, (1, False): 1, (1, True): 399}


def test_boosting_stops_early_under_every_strategy(spark):
    rows = skewed(spark, 60, 300)
    params = {"trees": 100, "depth": 2, "rate": 0.9, "min_leaf": 1, "subsample": 0.9, "columns": 0.9, "patience": 3}
    for strategy in ("smote", "undersample"):
        model = learners.fit(rows, ["a", "b"], "y", "boosted_trees", params, strategy=strategy, keys=["id"])
        assert len(model.feature) < 97


def test_ranks_number_ties_and_heavy_values(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") < 2500, 1.0).otherwise(F.rand(1)).alias("v"), F.xxhash64("id").alias("h"))
    got = [(r["v"], r["h"]) for r in numbered(rows, "v", ["h", "id"]).orderBy("_rank").collect()]
    assert got == sorted(got)
    assert numbered(rows, "v", ["h", "id"]).select("_rank").distinct().count() == 4000
