"""Exact nearest neighbours of every row, without forming distant pairs.

Rows go to the nearest of a bounded number of pivots; a part that is too large for a task is sliced by hash, so that a dense
region is many groups. Each row first looks in its own group, which bounds the distance of its k-th neighbour. It is then sent
only to groups whose pivot is near enough for that bound and the part's radius, the copies along borders: by the triangle
inequality no other group can hold a nearer row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewarden.storage import settled

#: More pivots make smaller parts, and every row is held against each pivot.
MOST_PIVOTS = 4096


def nearest_rows(rows: DataFrame, k: int, *, key: str = "_key", x: str = "_x", part_rows: int = 2_000, group_rows: int = 20_000, block_rows: int = 200_000) -> DataFrame:
    """(key, place, d2, x): the ``k`` nearest other rows of each row by squared distance, ties by key, places from 1.

    ``key`` is a text that names a row, ``x`` an array of doubles, of one length for all. Fewer rows give fewer neighbours.
    A task holds ``group_rows`` rows and about ``block_rows`` that look for neighbours among them, whatever the skew.
    """
    import pyarrow as pa
    import pyarrow.compute as pc
    points = settled(rows.select(F.col(key).alias("_key"), F.col(x).cast("array<double>").alias("_x")))
    n = points.count()
    schema = "_key string, d2 double, _other string, _at array<double>"
    if not n:
        return rows.sparkSession.createDataFrame([], schema).selectExpr("_key", "0 as place", "d2", "_at as _x").toDF(key, "place", "d2", x)
    heads = np.array([r[0] for r in points.orderBy(F.xxhash64("_key"), "_key").select("_x").limit(min(MOST_PIVOTS, max(1, n // part_rows))).collect()])

    def far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(2))

    step = max(1, (1 << 21) // heads.size)

    def of(column) -> np.ndarray:
        values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        return np.asarray(values.flatten()).reshape(len(values), -1)

    def dealt(batches):
        for batch in batches:
            values = of(batch.column(1))
            part, d = np.zeros(len(values), np.int64), np.zeros(len(values))
            for a in range(0, len(values), step):
                one = far(values[a: a + step], heads)
                part[a: a + step], d[a: a + step] = one.argmin(1), one.min(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part), pa.array(d)], names=["_key", "_x", "_part", "_d"])

    placed = settled(points.mapInArrow(dealt, "_key string, _x array<double>, _part long, _d double"))
    count, radius = np.zeros(len(heads), np.int64), np.zeros(len(heads))
    for r in placed.groupBy("_part").agg(F.count("*"), F.max("_d")).collect():  # at most MOST_PIVOTS rows
        count[r[0]], radius[r[0]] = r[1], r[2]
    slices = np.ceil(count / group_rows).astype(np.int64)
    slice_of = F.pmod(F.xxhash64("_key"), F.element_at(F.array(*(F.lit(max(1, int(s))) for s in slices)), (F.col("_part") + 1).cast("int")))
    placed = placed.withColumn("_group", F.col("_part") + slice_of * MOST_PIVOTS).drop("_part", "_d")

    def near(have, ask):
        found: list = [[], [], [], []]
        if len(have) and len(ask):
            values, keys = of(have["_x"]), np.array(have["_key"].to_pylist(), object)
            asked, names = of(ask["_x"]), ask["_key"].to_pylist()
            most = ask["_reach"].to_numpy() if "_reach" in ask.column_names else np.full(len(names), np.inf)
            some = max(1, (1 << 20) // len(values))
            for a in range(0, len(names), some):
                d2 = np.zeros((len(asked[a: a + some]), len(values)))
                for c in range(values.shape[1]):  # one feature after another: the sum is the same wherever a pair meets
                    d2 += (asked[a: a + some, c, None] - values[None, :, c]) ** 2
                for i in range(len(d2)):
                    # the k-th distance with all its ties, and the row itself
                    kth = np.partition(d2[i], min(k, len(values) - 1))[min(k, len(values) - 1)]
                    rows_ = np.flatnonzero(d2[i] <= min(kth, most[a + i]))
                    rows_ = [j for j in sorted(rows_, key=lambda j: (d2[i, j], keys[j])) if keys[j] != names[a + i]][:k]
                    found[0] += [names[a + i]] * len(rows_)
                    found[1] += [float(d2[i, j]) for j in rows_]
                    found[2] += [keys[j] for j in rows_]
                    found[3] += [values[j].tolist() for j in rows_]
        return pa.table({"_key": pa.array(found[0], pa.string()), "d2": pa.array(found[1], pa.float64()), "_other": pa.array(found[2], pa.string()),
                         "_at": pa.array(found[3], pa.list_(pa.float64()))})

    own = placed.groupBy("_group").applyInArrow(lambda table: near(table, table), schema)
    reach = own.groupBy("_key").agg(F.count("*").alias("_n"), F.max("d2").alias("_most")).select(
        "_key", F.when(F.col("_n") >= k, F.col("_most")).otherwise(float("inf")).alias("_reach"))
    asking = settled(points.join(reach, "_key", "left").na.fill(float("inf"), ["_reach"]))
    groups = [p + np.arange(s) * MOST_PIVOTS for p, s in enumerate(slices)]

    def spread(batches):
        for batch in batches:
            values, most = of(batch.column(1)), np.sqrt(batch.column(2).to_numpy())
            at = []
            for a in range(0, len(values), step):
                open_ = far(values[a: a + step], heads) - radius <= (most[a: a + step] * (1 + 1e-9) + 1e-9 * (1 + radius.max()))[:, None]
                at += [np.concatenate([groups[p] for p in np.flatnonzero(o)] or [np.zeros(0, np.int64)]) for o in open_]
            rows_ = pa.array(np.repeat(np.arange(len(at)), [len(g) for g in at]))
            yield pa.RecordBatch.from_arrays(
                [*(pc.take(c, rows_) for c in batch.columns), pa.array(np.concatenate([np.zeros(0, np.int64), *at]).astype(np.int64))], names=["_key", "_x", "_reach", "_group"])

    sent = asking.mapInArrow(spread, "_key string, _x array<double>, _reach double, _group long")
    # a group is only repeated for more rows than a task takes that look into it, whatever the rows in all
    blocks = F.broadcast(settled(sent.groupBy("_group").agg(F.ceil(F.count("*") / block_rows).alias("_blocks"))))
    sent = sent.join(blocks, "_group").withColumn("_block", F.pmod(F.xxhash64("_key"), F.col("_blocks"))).drop("_blocks")
    have = placed.join(blocks, "_group").withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))).drop("_blocks")
    both = have.groupBy("_group", "_block").cogroup(sent.groupBy("_group", "_block")).applyInArrow(near, schema)
    place = F.row_number().over(Window.partitionBy("_key").orderBy("d2", "_other"))
    return both.withColumn("place", place).where(F.col("place") <= k).select(F.col("_key").alias(key), "place", "d2", F.col("_at").alias(x))
