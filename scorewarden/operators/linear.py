"""Logistic regressions of many sets of rows in one pass: a job per Newton step adds up gradients and curvatures of all sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewarden.storage import settled

#: Rows of a block, and rows that a task holds until their blocks are full.
BLOCK_ROWS, WAITING_ROWS = 1 << 15, 1 << 20
#: Bytes of partial sums of a step that the driver adds up itself; more are added up by tasks.
SUMS_BYTES = 8 << 20


def _number(name: str) -> Column:
    return F.coalesce(F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(0.0)), F.lit(0.0))


class LinearModel:
    """Weights of the features and, last, the intercept."""

    def __init__(self, weights: Sequence[float]):
        self.weights = [float(w) for w in weights]

    def probability(self, features: Sequence[str]) -> Column:
        margin = F.lit(self.weights[-1])
        for w, f in zip(self.weights, features, strict=False):
            margin = margin + F.lit(w) * _number(f)
        return 1 / (1 + F.exp(-margin))


def fit_linear(
    rows: DataFrame, features: Sequence[str], label: str, candidates: Mapping[str, Mapping[str, float]], *, set_: str = "_set",
    weight: str = "weight", tolerance: float = 1e-8,
) -> dict[tuple[int, str], LinearModel]:
    """Models by (set, candidate). A candidate has ``C``, the inverse penalty of the summed loss, and ``max_iter``.

    The intercept has no penalty. A step that raises the loss is halved. What reaches the driver is a square of the number of features
    per set and candidate. Rows without a label are left out; a set without rows has no model.
    """
    import pyarrow as pa
    n, names = len(features) + 1, list(candidates)

    def blocks(batches):
        """A row per block of rows of one set: its features one after another, labels and weights."""
        waiting: dict = {}
        def block(s):
            parts = waiting.pop(s)
            values = [np.concatenate([p[i] for p in parts], -1) for i in range(3)]
            return pa.RecordBatch.from_arrays([pa.array([int(s)]), *(pa.array([v.tobytes()], pa.binary()) for v in values)], names=["_set", "_x", "_y", "_w"])
        for batch in batches:
            of, y, w = (batch.column(i).to_numpy() for i in range(3))
            x = np.stack([*(batch.column(3 + i).to_numpy() for i in range(n - 1)), np.ones(len(y))])
            order = np.argsort(of, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
                if not len(at):
                    continue
                s = of[at[0]]
                waiting.setdefault(s, []).append((x[:, at], y[at], w[at]))
                if sum(len(p[1]) for p in waiting[s]) >= BLOCK_ROWS:
                    yield block(s)
            if sum(len(p[1]) for parts in waiting.values() for p in parts) >= WAITING_ROWS:
                for s in list(waiting):
                    yield block(s)
        for s in list(waiting):
            yield block(s)

    held = settled(rows.where(F.col(label).isNotNull()).select(
        F.col(set_).cast("long").alias("_set"), F.col(label).cast("double").alias("_y"), F.col(weight).cast("double").alias("_w"),
        *(_number(f).alias(f"_{i}") for i, f in enumerate(features))).mapInArrow(blocks, "_set long, _x binary, _y binary, _w binary"))
    # a task has at most one row of sums per block and candidate
    few = held.count() * len(names) * (1 + n + n * n) * 8 <= SUMS_BYTES

    def sums(at: dict):
        def run(batches):
            found: dict = {}
            for batch in batches:
                for i in range(batch.num_rows):
                    s = batch.column(0)[i].as_py()
                    x, y, w = (np.frombuffer(batch.column(1 + k)[i].as_buffer()) for k in range(3))
                    x = x.reshape(n, -1)
                    for c in names:
                        beta = at.get((s, c), np.zeros(n))
                        if beta is None:
                            continue
                        z = beta @ x
                        e = np.exp(-np.abs(z))
                        p = np.where(z >= 0, 1, e) / (1 + e)
                        one = np.concatenate([
                            [(w * (np.maximum(z, 0) + np.log(1 + e) - y * z)).sum()], x @ (w * (p - y)), ((x * (w * p * (1 - p))) @ x.T).ravel()])
                        found[s, c] = found.get((s, c), 0) + one
            yield pa.RecordBatch.from_pylist(
                [{"_set": s, "_candidate": c, "_sums": v.tolist()} for (s, c), v in found.items()],
                schema=pa.schema([("_set", pa.int64()), ("_candidate", pa.string()), ("_sums", pa.list_(pa.float64()))]))
        return run

    def added(partial: DataFrame) -> dict:
        """The sums of all tasks by set and candidate."""
        if few:
            total: dict = {}
            for r in partial.collect():  # at most SUMS_BYTES
                k = r["_set"], r["_candidate"]
                total[k] = total.get(k, 0) + np.array(r["_sums"])
            return total
        each = partial.select("_set", "_candidate", F.posexplode("_sums").alias("_at", "_v")).groupBy("_set", "_candidate", "_at").agg(F.sum("_v").alias("_v"))
        return {(r["_set"], r["_candidate"]): np.array([x["_v"] for x in r["_sums"]]) for r in each.groupBy("_set", "_candidate").agg(
            F.array_sort(F.collect_list(F.struct("_at", "_v"))).alias("_sums")).collect()}

    beta: dict = {}
    step: dict = {}
    before: dict = {}
    for turn in range(max(int(c["max_iter"]) for c in candidates.values()) if candidates else 0):
        partial = held.mapInArrow(sums(beta), "_set long, _candidate string, _sums array<double>")
        for k, v in added(partial).items():
            if k in beta and beta[k] is None:
                continue
            now = beta.get(k, np.zeros(n))
            ridge = np.append(np.full(n - 1, 1 / candidates[k[1]]["C"]), 0.0)
            loss = v[0] + 0.5 * (ridge * now * now).sum()
            if k in before and loss > before[k] * (1 + 1e-12) + 1e-12 and np.abs(step[k]).max() > tolerance:
                step[k] = step[k] / 2
                beta[k] = now - step[k]
                continue
            move = np.linalg.lstsq(v[1 + n:].reshape(n, n) + np.diag(ridge), -(v[1: 1 + n] + ridge * now), rcond=None)[0]
            before[k], step[k], beta[k] = loss, move, now + move
            if np.abs(move).max() <= tolerance * max(1.0, np.abs(now).max()) or turn + 1 >= int(candidates[k[1]]["max_iter"]):
                step[k], beta[k], before[k] = beta[k], None, loss
        if all(b is None for b in beta.values()):
            break
    return {k: LinearModel(step[k] if b is None else b) for k, b in beta.items()}


def score_linear(rows: DataFrame, models: Mapping[tuple[int, str], LinearModel], features: Sequence[str], keep: Sequence[str], out: str = "pred_prob") -> DataFrame:
    """(*keep, _set, _candidate, score) of every row under each candidate's model of its set; the weights are a small literal table."""
    spark = rows.sparkSession
    table = spark.createDataFrame([(s, c, m.weights) for (s, c), m in models.items()], "_set long, _candidate string, _weights array<double>")
    margin = F.lit(0.0)
    for i, x in enumerate((*(_number(f) for f in features), F.lit(1.0))):
        margin = margin + x * F.col("_weights")[i]
    both = rows.withColumn("_set", F.col("_set").cast("long")).join(F.broadcast(table), "_set")
    return both.select(*keep, "_set", "_candidate", (1 / (1 + F.exp(-margin))).alias(out))
