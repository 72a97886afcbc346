"""Nearest neighbours against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from scorewarden.operators.neighbours import nearest_rows


def plain(rows, k):
    out = {}
    for name, x in rows:
        found = sorted((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), other) for other, y in rows if other != name)[:k]
        out[name] = [d for d, _ in found]
    return out


@pytest.mark.parametrize("part_rows, group_rows, block_rows", [(20, 15, 100), (1000, 10_000, 10_000)])
def test_neighbours_equal_all_pairs_with_a_dense_cell_and_ties(spark, part_rows, group_rows, block_rows):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(5, 3)) * 9
    rows = [(f"r{i}", (centres[i % 5] + rng.normal(size=3) * (0.01 if i % 5 == 0 else 1)).tolist()) for i in range(200)]
    rows += [(f"same{i}", [1.0, 2.0, 3.0]) for i in range(60)] + [("far", [500.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "_key string, _x array<double>")
    got = {}
    for r in nearest_rows(df, 4, part_rows=part_rows, group_rows=group_rows, block_rows=block_rows).orderBy("_key", "place").collect():
        got.setdefault(r["_key"], []).append((r["place"], r["d2"]))
    want = plain(rows, 4)
    assert set(got) == set(want)
    for name, places in got.items():
        assert [p for p, _ in places] == [1, 2, 3, 4] and np.allclose([d for _, d in places], want[name], atol=1e-9)


def test_few_rows_have_few_neighbours(spark):
    one = spark.createDataFrame([("a", [1.0])], "_key string, _x array<double>")
    assert nearest_rows(one, 3).count() == 0 and nearest_rows(one.limit(0), 3).count() == 0
    two = spark.createDataFrame([("a", [1.0]), ("b", [4.0])], "_key string, _x array<double>")
    assert sorted(map(tuple, nearest_rows(two, 3).collect())) == [("a", 1, 9.0, [4.0]), ("b", 1, 9.0, [1.0])]


def test_parts_stay_small_and_groups_are_not_repeated_for_all_rows(spark, monkeypatch):
    from scorewarden.operators import neighbours
    seen, plain_ = [], neighbours.settled
    monkeypatch.setattr(neighbours, "settled", lambda df: seen.append(plain_(df)) or seen[-1])
    rng = np.random.default_rng(3)
    rows = [(f"r{i}", rng.random(2).tolist()) for i in range(1500)]
    found = nearest_rows(spark.createDataFrame(rows, "_key string, _x array<double>"), 3, part_rows=5, block_rows=300)
    assert found.count() == 4500
    placed = next(d for d in seen if "_part" in d.columns)
    assert placed.select("_part").distinct().count() > 256
    blocks = next(d for d in seen if "_blocks" in d.columns)  # five blocks each, if all rows counted
    assert blocks.agg({"_blocks": "sum"}).first()[0] < 2 * blocks.count()
