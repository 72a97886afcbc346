"""Mapped scores keep the order of the raw ones, every two neighbours of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import QUERIES, models
from scorewarden.operators import linear
from scorewarden.plans import training
from tests.conftest import SMALL


class _Zigzag:
    """Rises from one hundredth to the next and falls within each."""
    model = linear.LinearModel([1.0, 0.1, 0.0, 0.0, 0.0])

    def score(self, df):
        raw = self.model.probability(models._FEATURES)
        return df.withColumn("pred_prob", F.round(raw, 2) - 0.3 * (raw - F.round(raw, 2)))


def test_the_order_of_all_raw_scores_is_held_also_within_a_hundredth(spark, monkeypatch):
    monkeypatch.setattr(training, "retrain", lambda *a, **k: _Zigzag())
    for name in ("calibrated_scores", "sigmoid_scores"):
        found = QUERIES[name](spark, SMALL)
        assert {r["monotone"] for r in found.select("monotone").distinct().collect()} == {False}


def test_neighbours_meet_across_buckets(spark):
    rising = spark.range(0, 2000).selectExpr("id / 2000D as raw", "id / 4000D as p")
    got = lambda df: tuple(models._neighbours(df, "raw", "p").selectExpr("bool_and(rising)", "bool_and(falling)").first())
    assert got(rising) == (True, False) and got(rising.selectExpr("raw", "1 - p as p")) == (False, True)
    assert got(rising.selectExpr("raw", "case when raw >= 0.5 then p - 0.2 else p end as p")) == (False, False)
    assert got(rising.limit(0)) == (None, None)
