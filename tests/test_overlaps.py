"""Metrics of groups that share rows, such as windows, against metrics of the unfolded rows."""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from scorewarden.operators.metrics import classification_metrics, overlapping_metrics
from tests.conftest import SMALL


def test_groups_that_share_days_have_the_figures_of_their_unfolded_rows(spark):
    rng = np.random.default_rng(5)
    days = [None, *(dt.date(2020, 1, 1 + i) for i in range(6))]
    made = [(days[rng.integers(7)], str(rng.choice(["a", "b"])), int(rng.integers(2)), float(rng.integers(40)) / 40) for _ in range(800)]
    made += [(days[1], "a", None, 0.5), (days[1], "a", 1, None), (days[2], "b", 0, float("nan")), (dt.date(2021, 1, 1), "a", 1, 0.9)]
    rows = spark.createDataFrame(made, "day date, model string, y int, p double")
    named = [(d, g, "x" if g else None) for i, d in enumerate(days) for g in range(4) if (i + g) % 3 or g == 3]
    groups = spark.createDataFrame(named, "day date, g int, part string")
    got = overlapping_metrics(rows, "y", "p", groups, "day", ["model"])
    unfolded = rows.withColumnRenamed("day", "d").join(groups, F.col("d").eqNullSafe(F.col("day")))
    want = classification_metrics(unfolded, "y", "p", ["model", "g", "part"])
    key = lambda r: (r["model"], r["g"])
    one, other = (sorted(x.select(*want.columns).collect(), key=key) for x in (got, want))
    assert len(one) == len(other) == 8
    for a, b in zip(one, other, strict=True):
        assert a[:3] == b[:3] and np.allclose(a[3:], b[3:])


def test_windows_of_the_same_rows_do_not_multiply_what_is_shuffled(spark):
    from catalog.decisions import _figures
    from scorewarden.operators import metrics
    seen, plain = [], metrics.overlapping_metrics

    def spy(df, label, score, groups, on, by):
        seen.append((df.count(), groups.count()))
        return plain(df, label, score, groups, on, by)

    metrics.overlapping_metrics = spy
    try:
        figures = _figures(spark, SMALL)
    finally:
        metrics.overlapping_metrics = plain
    rows, _ = seen[0]
    # each row is counted in two train windows, a monitor window and a fold at most; what goes in has it once per model
    assert figures.agg(F.sum("rows")).first()[0] > rows * 1.5 and rows == 3 * spark.read.parquet(f"{SMALL}/lineitem.parquet").count()


def test_rows_of_shared_days_are_neither_unfolded_nor_sorted_per_group(spark):
    made = [(dt.date(2020, 1, 1 + i % 6), i % 2, i % 101 / 101) for i in range(400)]
    rows = spark.createDataFrame(made, "day date, y int, p double")
    groups = spark.createDataFrame([(dt.date(2020, 1, 1 + d), g) for d in range(6) for g in range(40)], "day date, g int")
    found = overlapping_metrics(rows, "y", "p", groups, "day")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Join") <= 1  # rows meet the span of their day, and no group of it
    want = classification_metrics(rows, "y", "p").first()
    got = found.collect()
    assert len(got) == 40 and all(np.allclose(r[1:], want) for r in got)
