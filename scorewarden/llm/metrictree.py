"""Exact top-k inner products: best-first search over the pages of an M-tree.

Vectors become integers, floor(scale * component). With M2 the largest squared length, a data vector x stands for the point
(x, sqrt(M2 - |x|^2)) and a query q for (q, 0); then |q - x|^2 = |q|^2 + M2 - 2<q, x>, so that the nearest points have the
highest inner products and the triangle inequality holds. The tree has three levels: parts around pivots, nodes (slices of
a part that fit one task), and leaf pages around pivots of their own. Every entry has its distance to its parent's pivot and
every page its covering radius, so that most distances are bounded from stored numbers and never computed.

Equal vectors are one entry with their smallest ids: of n equal vectors only the k + 1 smallest ids can ever be among k
results. Queries that are equal are searched once. Float bounds carry a slack far above their rounding, scores are exact.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewarden.llm.common import settled
from scorewarden.storage import BROADCAST_BYTES, left_lookup

_MOST_PARTS = 256
_LONG = (1 << 63) - 1


def integer_vectors(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """(_id, _v, _norm2): ``floor(scale * x)`` of each component as packed doubles, which hold them exactly.

    Rows whose key or vector is null, or whose vector holds a null or a component that is not finite after scaling, are
    left out. Vectors may differ in length: missing components count as 0, an empty vector scores 0 with all.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches):
        for batch in batches:
            ids, lists = batch.columns
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            with np.errstate(all="ignore"):
                x = np.floor(scale * np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)) + 0.0
                ends = np.cumsum(lengths)
                bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
                good = bad[ends] == bad[ends - lengths]
                squares = np.concatenate([[0.0], np.cumsum(np.where(np.isfinite(x), x, 0) ** 2)])
                # the rounding of the running sums is far below the slack of the bounds; what isn't a number drops nothing
                norm2 = np.maximum(squares[ends] - squares[ends - lengths], 0)
            good = good & pc.and_(ids.is_valid(), lists.is_valid()).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(lengths[good])]).astype(np.int64) * 8
            kept = x[np.repeat(good, lengths)]
            packed = pa.Array.from_buffers(pa.large_binary(), int(good.sum()), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]).cast(pa.binary())
            norm2 = norm2[good]
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(good)), packed, pa.array(norm2)], names=["_id", "_v", "_norm2"])

    return rows.select(F.col(f"`{key}`").cast("long").alias("_id"), F.col(f"`{vector}`").cast("array<double>").alias("_x")).mapInArrow(
        run, "_id long, _v binary, _norm2 double")


def matrix(packed, dim: int) -> np.ndarray:
    """Packed vectors as the rows of a matrix of ``dim`` columns, filled up with zeros; further components meet no entry's."""
    out = np.zeros((len(packed), dim))
    for i, one in enumerate(packed.to_pylist() if hasattr(packed, "to_pylist") else packed):
        row = np.frombuffer(one)[:dim]
        out[i, : len(row)] = row
    return out


def inner(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products, held within 2^63 - 1 of 0."""
    with np.errstate(all="ignore"):
        if np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(1, len(q)) < 2.0 ** 53:
            return (x @ q).astype(np.int64)
    whole = [int(b) for b in q]
    return np.array([max(-_LONG, min(_LONG, sum(int(a) * b for a, b in zip(row, whole, strict=True)))) for row in x], np.int64)


def _lift(norm2: np.ndarray, most: float) -> np.ndarray:
    return np.sqrt(np.maximum(most - norm2, 0))


def _between(x, lift_x, y, lift_y, most) -> np.ndarray:
    """Distances of data points to data points; all of them lie on a sphere."""
    return np.sqrt(np.maximum(2 * most - 2 * (x @ y.T + np.multiply.outer(lift_x, lift_y)), 0))


@dataclass
class Tree:
    """An index: its leaf ``pages`` and, for the top level, pivots, covering radii and the number of nodes of each part."""

    pages: DataFrame
    rows: int
    dim: int
    most: float
    pivots: np.ndarray
    radii: np.ndarray
    slices: np.ndarray

    @property
    def nodes(self) -> int:
        return int(self.slices.sum())


def node_of(part, slice_) -> Column:
    return part + slice_ * _MOST_PARTS


def build(vectors: DataFrame, *, most_ids: int = 11, page: int = 64, part_rows: int = 2048, node_bytes: int = 16 << 20) -> Tree:
    """Index every row of ``integer_vectors``; each entry keeps its ``most_ids`` smallest ids.

    At most 256 pivots reach the driver. Nodes take part slices by hash, about ``node_bytes`` at most, so no group grows
    with a dense region; a page holds at most ``2 * page`` entries. An empty table gives an index without pages.
    """
    import pyarrow as pa
    ranked = vectors.withColumn("_n", F.row_number().over(Window.partitionBy("_v").orderBy("_id"))).where(F.col("_n") <= most_ids)
    entries = settled(ranked.groupBy("_v").agg(F.max("_norm2").alias("_norm2"), F.sort_array(F.collect_list("_id")).alias("_ids")))
    n, most, width = entries.agg(F.count("*"), F.max("_norm2"), F.max(F.length("_v"))).first()
    most, dim = float(most or 0), max(1, (width or 0) // 8)
    parts = min(_MOST_PARTS, max(1, n // part_rows))
    heads = [r[0] for r in entries.select("_v").orderBy(F.xxhash64("_v"), "_v").limit(parts).collect()]
    pivots = matrix(heads, dim)

    def nearest(batches):
        lift = _lift((pivots ** 2).sum(1), most)
        for batch in batches:
            with np.errstate(all="ignore"):
                d = _between(matrix(batch.column(0), dim), _lift(batch.column(1).to_numpy(), most), pivots, lift, most)
            part = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(part.astype(np.int32)), pa.array(d[np.arange(len(d)), part])], names=["_v", "_norm2", "_ids", "_part", "_d"])

    schema = "_v binary, _norm2 double, _ids array<long>, _part int, _d double"
    dealt = settled(entries.mapInArrow(nearest, schema)) if n else entries.withColumns({"_part": F.lit(0), "_d": F.lit(0.0)})
    count, radii = np.zeros(len(heads), np.int64), np.zeros(len(heads))
    for r in dealt.groupBy("_part").agg(F.count("*"), F.max("_d")).collect():  # at most 256 rows
        count[r[0]], radii[r[0]] = r[1], r[2]
    slices = np.ceil(count / max(page, node_bytes // (8 * dim))).astype(np.int64)
    node = node_of(F.col("_part"), F.pmod(F.xxhash64("_v"), F.element_at(F.array(*(F.lit(max(1, int(s))) for s in slices), F.lit(1)), F.col("_part") + 1)))

    def pages(table):
        table = table.sort_by("_d")
        x, norm2 = matrix(table["_v"], dim), table["_norm2"].to_numpy()
        to_parent, lift = table["_d"].to_numpy(), _lift(norm2, most)
        part = int(table["_node"][0].as_py()) % _MOST_PARTS
        spots = np.unique(np.linspace(0, len(x) - 1, -(-len(x) // page)).astype(np.int64))
        own, d = np.zeros(len(x), np.int64), np.zeros(len(x))
        with np.errstate(all="ignore"):
            for a in range(0, len(x), 4096):
                far = _between(x[a: a + 4096], lift[a: a + 4096], x[spots], lift[spots], most)
                own[a: a + 4096] = far.argmin(1)
                d[a: a + 4096] = far.min(1)
        order = np.lexsort((d, own))
        first = np.flatnonzero(np.r_[True, np.diff(own[order]) > 0, True])
        cuts = np.concatenate([np.arange(a, b, 2 * page) for a, b in zip(first[:-1], first[1:], strict=True)] + [[len(x)]])
        out = {k: [] for k in ("_node", "_parent", "_pivot", "_to_parent", "_radius", "_n", "_entries", "_distances", "_copies", "_ids")}
        ids = table["_ids"].to_pylist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            rows = order[a:b]
            spot = spots[own[rows[0]]]
            for k, v in zip(out, (
                    int(table["_node"][0].as_py()), pivots[part].tobytes(), x[spot].tobytes(), to_parent[spot], d[rows].max(), len(rows),
                    x[rows].tobytes(), d[rows].tobytes(), [len(ids[i]) for i in rows], [v for i in rows for v in ids[i]]), strict=True):
                out[k].append(v)
        return pa.table(out, schema=pa.schema([
            ("_node", pa.int64()), ("_parent", pa.binary()), ("_pivot", pa.binary()), ("_to_parent", pa.float64()), ("_radius", pa.float64()),
            ("_n", pa.int32()), ("_entries", pa.binary()), ("_distances", pa.binary()), ("_copies", pa.list_(pa.int32())), ("_ids", pa.list_(pa.int64()))]))

    made = dealt.withColumn("_node", node.cast("long")).groupBy("_node").applyInArrow(
        pages, "_node long, _parent binary, _pivot binary, _to_parent double, _radius double, _n int, _entries binary, _distances binary, "
        "_copies array<int>, _ids array<long>")
    return Tree(settled(made), int(n), dim, most, pivots, radii, slices)


class Node:
    """The pages of one node, ready to be searched."""

    def __init__(self, pages, dim: int, most: float):
        self.most = most
        self.parent = np.frombuffer(pages["_parent"][0].as_py())
        self.pivots = matrix(pages["_pivot"], dim)
        self.to_parent, self.radius = pages["_to_parent"].to_numpy(), pages["_radius"].to_numpy()
        self.reach = float((self.to_parent + self.radius).max())
        self.cuts = np.concatenate([[0], np.cumsum(pages["_n"].to_numpy())])
        self.x = np.frombuffer(b"".join(pages["_entries"].to_pylist())).reshape(-1, dim)
        with np.errstate(all="ignore"):
            self.norm2 = (self.x ** 2).sum(1)
        self.d = np.frombuffer(b"".join(pages["_distances"].to_pylist()))
        copies = np.concatenate([np.asarray(c) for c in pages["_copies"].to_pylist()])
        self.id_cuts = np.concatenate([[0], np.cumsum(copies)])
        self.ids = np.concatenate([np.asarray(c, np.int64) for c in pages["_ids"].to_pylist()])

    def search(self, q: np.ndarray, k: int, best: list[np.ndarray], least: float) -> list[np.ndarray]:
        """``best`` (scores, ids, equal to the query) after this node; pages in the order of their bounds, until none can hold a result.

        Bounds drop only what is certainly below ``least`` or the k-th score; what isn't a number drops nothing.
        """
        q2 = float(q @ q)
        slack = 1e-6 * (np.sqrt(self.most) + np.sqrt(q2))

        def reach() -> float:
            kth = max(least, float(best[0][-1])) if len(best[0]) >= k else least
            return float(np.sqrt(max(0.0, q2 + self.most - 2 * kth))) + slack if kth > -np.inf else np.inf

        within = reach()
        d0 = float(np.sqrt(max(0.0, q2 + self.most - 2 * float(self.parent @ q))))
        if d0 - self.reach > within:
            return best
        low = np.abs(d0 - self.to_parent) - self.radius
        open_ = np.flatnonzero(~(low > within))
        d = np.sqrt(np.maximum(q2 + self.most - 2 * (self.pivots[open_] @ q), 0))
        bound = np.maximum(d - self.radius[open_], low[open_])
        for i in np.argsort(bound):
            within = reach()
            if bound[i] > within:
                break
            a, b = self.cuts[open_[i]], self.cuts[open_[i] + 1]
            rows = a + np.flatnonzero(~(np.abs(d[i] - self.d[a:b]) > within))
            if not len(rows):
                continue
            scores = inner(self.x[rows], q)
            good = scores >= (max(least, best[0][-1]) if len(best[0]) >= k else least)
            rows, scores = rows[good], scores[good]
            if len(rows):
                copies = self.id_cuts[rows + 1] - self.id_cuts[rows]
                at = np.repeat(self.id_cuts[rows] - np.cumsum(copies) + copies, copies) + np.arange(copies.sum())
                same = (scores == q2) & (self.norm2[rows] == q2)
                merged = [np.concatenate([old, new]) for old, new in zip(
                    best, (np.repeat(scores, copies), self.ids[at], np.repeat(same, copies)), strict=True)]
                order = np.lexsort((merged[1], -merged[0]))[:k]
                best = [m[order] for m in merged]
        return best


def search(tree: Tree, queries: DataFrame, k: int, *, block_bytes: int = 64 << 20) -> DataFrame:
    """(_v, _score, _id, _same): the ``k`` best entries of each distinct query vector in ``queries`` (_v), ties to smaller ids.

    Each query first searches the node of its nearest pivot; that k-th score prunes whole parts before a query is sent
    anywhere. What is left meets in groups of about ``block_bytes`` of pages and of queries at most.
    """
    import pyarrow as pa
    dim, most, pivots, radii, slices = tree.dim, tree.most, tree.pivots, tree.radii, tree.slices
    wanted = settled(queries.select("_v").distinct())
    size = wanted.agg(F.count("*"), F.max(F.length("_v"))).first()
    blocks = max(1, -(-size[0] * ((size[1] or 0) + 16) // block_bytes))
    parallel = queries.sparkSession.sparkContext.defaultParallelism
    buckets = max(1, min(tree.nodes, max(-(-tree.rows * dim * 8 // block_bytes), 2 * parallel)))

    def home(batches):
        for batch in batches:
            q = matrix(batch.column(0), dim)
            part = (q @ pivots.T).argmax(1)
            slot = np.array([zlib.crc32(v) for v in batch.column(0).to_pylist()], np.int64) % np.maximum(1, slices[part])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part + slot * _MOST_PARTS)], names=["_v", "_node"])

    def run(pages, asked, first: bool):
        out: list[list] = [[], [], [], []]
        if len(pages):
            nodes = [Node(pages.filter(pa.compute.equal(pages["_node"], i)), dim, most) for i in pages["_node"].unique()]
            values = asked["_v"].to_pylist()
            least = [-np.inf] * len(values) if first else asked["_least"].to_pylist()
            q = matrix(values, dim)
            for i, v in enumerate(values):
                best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]
                for node in sorted(nodes, key=lambda node: -float(node.parent @ q[i])):
                    best = node.search(q[i], k, best, least[i])
                if first:
                    best = [b[k - 1: k] for b in best]
                out[0] += [v] * len(best[0])
                for to, column in zip(out[1:], best, strict=True):
                    to.append(column)
        flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out[1:]]
        return pa.table({"_v": pa.array(out[0], pa.binary()), "_score": flat[0], "_id": flat[1], "_same": flat[2].astype(bool)})

    schema = "_v binary, _score long, _id long, _same boolean"
    if not tree.nodes:
        return queries.sparkSession.createDataFrame([], schema)
    homes = wanted.mapInArrow(home, "_v binary, _node long")
    seeds = tree.pages.groupBy("_node").cogroup(homes.groupBy("_node")).applyInArrow(lambda a, b: run(a, b, True), schema)
    started = settled(wanted.join(seeds.select("_v", F.col("_score").cast("double").alias("_least")), "_v", "left").na.fill(float("-inf"), ["_least"]))
    part_buckets = [np.unique((p + np.arange(s) * _MOST_PARTS) % buckets) for p, s in enumerate(slices)]

    def spread(batches):
        for batch in batches:
            q, least = matrix(batch.column(0), dim), batch.column(1).to_numpy()
            with np.errstate(all="ignore"):
                q2 = (q ** 2).sum(1)
                d = np.sqrt(np.maximum(q2[:, None] + most - 2 * (q @ pivots.T), 0))
                within = np.sqrt(np.maximum(q2 + most - 2 * least, 0)) + 1e-6 * (np.sqrt(most) + np.sqrt(q2))
                open_ = ~(d - radii > within[:, None])
            at = [np.unique(np.concatenate([part_buckets[p] for p in np.flatnonzero(o)] or [np.zeros(0, np.int64)])) for o in open_]
            rows = np.repeat(np.arange(len(at)), [len(a) for a in at])
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(rows)) for c in batch.columns), pa.array(np.concatenate([np.zeros(0, np.int64), *at]).astype(np.int64))],
                names=["_v", "_least", "_bucket"])

    asked = started.mapInArrow(spread, "_v binary, _least double, _bucket long").withColumn("_block", F.pmod(F.xxhash64("_v"), F.lit(blocks)))
    given = tree.pages.withColumns({"_bucket": F.pmod("_node", F.lit(buckets)), "_block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))})
    found = given.groupBy("_bucket", "_block").cogroup(asked.groupBy("_bucket", "_block")).applyInArrow(lambda a, b: run(a, b, False), schema)
    order = Window.partitionBy("_v").orderBy(F.desc("_score"), "_id")
    return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")


def nearest_others(rows: DataFrame, is_query: Column, *, key: str = "vec_id", vector: str = "embedding", k: int = 10, scale: float = 1024.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products of each query row with the other rows.

    Queries are the rows where ``is_query`` holds. Ties go to the smaller id. Repeated rows are rows of their own: each
    repeated query has its own results, and a copy of a query's row is a candidate like any other. Rows without a key or a
    whole finite vector take no part; an empty table gives no rows. Scores beyond 2^63 - 1 are held there. Other columns are ignored.
    """
    vectors = integer_vectors(rows, key=key, vector=vector, scale=scale)
    tree = build(vectors, most_ids=k + 1)
    asked = settled(integer_vectors(rows.where(is_query), key=key, vector=vector, scale=scale).select("_id", "_v"))
    best = search(tree, asked, k + 1)
    packed = best.groupBy("_v").agg(F.sort_array(F.collect_list(F.struct((-F.col("_score").cast("decimal(20,0)")).alias("o"), F.col("_id").alias("i"), F.col("_score").alias("s"), F.col("_same").alias("e")))).alias("_found"))
    total = max(1, asked.count())
    share = asked.groupBy("_v").agg((F.count("*") / total).alias("_share"))
    # a found list is about 20 * (k + 1) bytes more than the width that left_lookup counts for it
    fits = BROADCAST_BYTES * 64 // (64 + tree.dim * 8 + 40 * (k + 1))
    both = left_lookup(asked.withColumnRenamed("_id", "query_id"), packed.join(share, "_v"), ["_v"], weight="_share", max_bytes=fits)
    own = F.array_position(F.transform("_found", lambda x: (x["i"] == F.col("query_id")) & x["e"]), True)
    one = both.select("query_id", own.alias("_own"), F.posexplode("_found").alias("_at", "_one")).where(F.col("_at") + 1 != F.col("_own"))
    rank = F.col("_at") + 1 - ((F.col("_own") > 0) & (F.col("_own") <= F.col("_at"))).cast("int")
    return one.select("query_id", rank.cast("int").alias("rank"), F.col("_one")["i"].alias("vec_id"), F.col("_one")["s"].alias("score")).where(F.col("rank") <= k)
