"""Ranked lexical search: a tree of items against trees of documents, pruned by coordinate maxima.

A document is a sparse vector of impacts, c = (10^9 tf) div (1000 tf + 12 m), an item one of weights, w times the term's
repeats; their score is the product. Each node of a tree holds, per term, the maximum of its vectors, so that the product of two
nodes' maxima is above every score between them. A pair of nodes is left out when that bound is below the weakest k-th score
of the items in it; what remains is multiplied leaf by leaf. Documents form a tree per Arrow batch where they lie: nothing is
shuffled but results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewarden.llm.common import settled
from scorewarden.llm.terms import term_bytes, term_counts

_TABLE = term_bytes(digits=True)


@dataclass
class Sparse:
    """Rows of (code, value), sorted by code within a row: row i is at cuts[i] to cuts[i + 1]."""

    cuts: np.ndarray
    codes: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.cuts) - 1

    def take(self, rows: np.ndarray) -> Sparse:
        n = self.cuts[rows + 1] - self.cuts[rows]
        cuts = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.cuts[rows] - cuts[:-1], n) + np.arange(cuts[-1])
        return Sparse(cuts, self.codes[at], self.values[at])

    def maxima(self, edges: np.ndarray) -> Sparse:
        """One row per run of rows between two edges: the largest value per code."""
        run = np.repeat(np.arange(len(edges) - 1), self.cuts[edges[1:]] - self.cuts[edges[:-1]])
        order = np.lexsort((self.codes, run))
        run, codes = run[order], self.codes[order]
        if not len(run):
            return Sparse(np.zeros(len(edges), np.int64), codes, self.values[:0])
        first = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (codes[1:] != codes[:-1])])
        values = np.maximum.reduceat(self.values[order], first)
        return Sparse(np.concatenate([[0], np.cumsum(np.bincount(run[first], minlength=len(edges) - 1))]), codes[first], values)


def levels(rows: Sparse, edges: np.ndarray, fan: int) -> list[tuple[np.ndarray, Sparse]]:
    """Levels of a tree over sorted rows, leaves first: the edges of each level's runs in the one below, and its maxima."""
    out = [(edges, rows.maxima(edges))]
    while len(out[-1][1]) > 1:
        n = len(out[-1][1])
        edges = np.unique(np.r_[np.arange(0, n, fan), n])
        out.append((edges, out[-1][1].maxima(edges)))
    return out


def row_sums(rows: Sparse, dense: np.ndarray) -> np.ndarray:
    """Product of each row with a dense vector."""
    sums = np.concatenate([[0.0], np.cumsum(rows.values * dense[rows.codes])])
    return sums[rows.cuts[1:]] - sums[rows.cuts[:-1]]


def strongest_order(rows: Sparse) -> np.ndarray:
    """Rows by the code of their largest value, so that neighbours have their maxima in common."""
    heads = np.full(len(rows), -1, np.int64)
    full = np.flatnonzero(np.diff(rows.cuts))
    if len(full):
        most = np.maximum.reduceat(rows.values, rows.cuts[full])
        owner = np.repeat(np.arange(len(rows)), np.diff(rows.cuts))
        top = np.zeros(len(rows))
        top[full] = most
        at = np.flatnonzero(rows.values == top[owner])
        heads[owner[at[::-1]]] = rows.codes[at[::-1]]
    return np.argsort(heads, kind="stable")


class Items:
    """The tree of one block of items, and the results of each so far."""

    def __init__(self, rows: Sparse, vocabulary: int, k: int, least: np.ndarray, leaf: int = 8, fan: int = 4):
        self.order = strongest_order(rows)
        self.rows, self.k, self.vocabulary = rows.take(self.order), k, vocabulary
        n = len(rows)
        self.levels = levels(self.rows, np.unique(np.r_[np.arange(0, n, leaf), n]), fan)
        self.least = least[self.order].astype(np.int64)
        self.scores = [np.zeros(0, np.int64)] * n
        self.docs = [np.zeros(0, np.int64)] * n
        edges, maxima = self.levels[0]
        self.blocks = []
        for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            codes = maxima.codes[maxima.cuts[i]: maxima.cuts[i + 1]]
            dense = np.zeros((len(codes), b - a))
            for j in range(a, b):
                s = slice(self.rows.cuts[j], self.rows.cuts[j + 1])
                dense[np.searchsorted(codes, self.rows.codes[s]), j - a] = self.rows.values[s]
            self.blocks.append((codes, dense))
        self.heaviest = float(max((d.sum(0).max(initial=0) for _, d in self.blocks), default=0))

    def weakest(self) -> list[np.ndarray]:
        """Per level and node, the weakest k-th score of its items; scores below it can't be results."""
        out, low = [], self.least
        for edges, _ in self.levels:
            low = np.minimum.reduceat(low, edges[:-1])
            out.append(low)
        return out

    def open_leaves(self, maxima: Sparse, i: int, scratch: np.ndarray) -> np.ndarray:
        """Item leaves that a document node can have a result with, from the root down."""
        codes, values = maxima.codes[maxima.cuts[i]: maxima.cuts[i + 1]], maxima.values[maxima.cuts[i]: maxima.cuts[i + 1]]
        scratch[codes] = values
        weakest, nodes = self.weakest(), np.arange(len(self.levels[-1][1]))
        for level in range(len(self.levels) - 1, -1, -1):
            edges, items = self.levels[level]
            # sums of exact integers in doubles; the margin covers their rounding where they pass 2 ** 53
            bound = row_sums(items.take(nodes), scratch) * (1 + 1e-9) + 1
            nodes = nodes[(bound > 1) & (bound >= weakest[level][nodes])]
            if not len(nodes):
                break
            if level:
                nodes = np.concatenate([np.arange(edges[j], edges[j + 1]) for j in nodes])
        scratch[codes] = 0
        return nodes

    def add(self, item: int, scores: np.ndarray, docs: np.ndarray) -> None:
        scores, docs = np.concatenate([self.scores[item], scores]), np.concatenate([self.docs[item], docs])
        order = np.lexsort((docs, -scores))[: self.k]
        self.scores[item], self.docs[item] = scores[order], docs[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], int(scores[order[-1]]))

    def search(self, docs: Sparse, ids: np.ndarray, leaf: int = 128, fan: int = 8, most_cells: int = 1 << 15) -> None:
        """Rank one batch of documents; ids break ties, so they are numbers in the order wanted."""
        order = strongest_order(docs)
        docs, ids = docs.take(order), ids[order]
        edges, n = [0], len(docs)
        while edges[-1] < n:
            a = edges[-1]
            edges.append(max(a + 1, min(a + leaf, int(np.searchsorted(docs.cuts, docs.cuts[a] + most_cells, "right")) - 1, n)))
        tree = levels(docs, np.array(edges), fan)
        scratch, place = np.zeros(self.vocabulary), np.full(self.vocabulary, -1, np.int64)
        exact = self.heaviest * float(docs.values.max(initial=0)) < 2.0 ** 53
        stack = [(len(tree) - 1, i) for i in range(len(tree[-1][1]))]
        while stack:
            level, i = stack.pop()
            open_ = self.open_leaves(tree[level][1], i, scratch)
            if not len(open_):
                continue
            a, b = tree[level][0][i], tree[level][0][i + 1]
            if level:
                stack.extend((level - 1, j) for j in range(a, b))
                continue
            rows = docs.take(np.arange(a, b))
            codes = tree[0][1].codes[tree[0][1].cuts[i]: tree[0][1].cuts[i + 1]]
            place[codes] = np.arange(len(codes))
            dense = np.zeros((b - a, len(codes)), np.float64 if exact else np.int64)
            dense[np.repeat(np.arange(b - a), np.diff(rows.cuts)), place[rows.codes]] = rows.values
            for j in open_:
                own, weights = self.blocks[j]
                at = place[own]
                here = at >= 0
                scores = (dense[:, at[here]] @ weights[here].astype(dense.dtype)).astype(np.int64)
                first = self.levels[0][0][j]
                for item in range(first, first + scores.shape[1]):
                    one = scores[:, item - first]
                    good = np.flatnonzero((one >= self.least[item]) & (one > 0))
                    if len(good):
                        self.add(item, one[good], ids[a:b][good])
            place[codes] = -1


def _item_terms(items: DataFrame) -> DataFrame:
    """(_item, item_id, _term, _n): terms of each item with their repeats."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for row, code, count, terms in term_counts(batch.column(2), _TABLE):
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), terms.take(pa.array(code)).cast(pa.string()), pa.array(count)], names=["_item", "item_id", "_term", "_n"])

    return items.mapInArrow(run, "_item long, item_id long, _term string, _n long")


def _vectors(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(_id, _n, _codes, _tfs) per document with terms, and per task a row with _df (code, documents), _docs and _all (terms)."""
    import pyarrow as pa
    import pyarrow.compute as pc
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([
        ("_id", pa.int64()), ("_n", pa.int64()), ("_codes", pa.list_(pa.int32())), ("_tfs", pa.list_(pa.int64())),
        ("_df", pa.list_(pa.int64())), ("_docs", pa.int64()), ("_all", pa.int64())])

    def lists(cuts, values, kind):
        return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))

    def run(batches):
        words = pa.array([w.encode() for w in sent.value], pa.large_binary())
        df, all_docs, all_terms = np.zeros(len(words), np.int64), 0, 0
        for batch in batches:
            for row, code, count, terms in term_counts(batch.column(1), _TABLE):
                if not len(row):
                    continue
                own = pc.fill_null(pc.index_in(terms, words), -1).to_numpy()[code]
                rows, first = np.unique(row, return_index=True)
                totals = np.add.reduceat(count, first)
                hit = own >= 0
                place = np.searchsorted(rows, row[hit])
                order = np.lexsort((own[hit], place))
                codes, tfs = own[hit][order], count[hit][order]
                cuts = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(rows)))])
                df += np.bincount(codes, minlength=len(words))
                all_docs, all_terms = all_docs + len(rows), all_terms + int(totals.sum())
                full = np.diff(cuts) > 0  # the others only count in the totals
                if not full.any():
                    continue
                none = pa.nulls(int(full.sum()), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows[full])), pa.array(totals[full]), lists(cuts[np.r_[True, full]], codes, pa.int32()),
                    lists(cuts[np.r_[True, full]], tfs, pa.int64()), pa.nulls(len(none), pa.list_(pa.int64())), none, none], schema=schema)
        yield pa.RecordBatch.from_pylist([{"_df": df.tolist(), "_docs": all_docs, "_all": all_terms}], schema=schema)

    return docs.mapInArrow(run, "_id long, _n long, _codes array<int>, _tfs array<long>, _df array<long>, _docs long, _all long")


def _ranked(vectors: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], vocabulary: int, least: np.ndarray, k: int) -> DataFrame:
    """(_at, doc_id, score): the ``k`` best documents (_id, _m, _codes, _tfs) of each item, by its position in ``items``."""
    import pyarrow as pa
    sent = vectors.sparkSession.sparkContext.broadcast((items, least))

    def run(batches):
        rows, low = sent.value
        cuts = np.concatenate([[0], np.cumsum([len(c) for c, _ in rows])])
        tree = Items(Sparse(cuts, np.concatenate([c for c, _ in rows]), np.concatenate([w for _, w in rows]).astype(np.float64)), vocabulary, k, low)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            codes, tfs = batch.column(2), batch.column(3)
            n = pa.compute.list_value_length(codes).to_numpy().astype(np.int64)
            tf = tfs.flatten().to_numpy().astype(np.int64)
            impact = (1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(batch.column(1).to_numpy(), n))
            tree.search(Sparse(np.concatenate([[0], np.cumsum(n)]), codes.flatten().to_numpy().astype(np.int64), impact.astype(np.float64)), ids)
        at = np.repeat(tree.order, [len(s) for s in tree.scores])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int64)), pa.array(np.concatenate(tree.docs)), pa.array(np.concatenate(tree.scores))], names=["_at", "doc_id", "score"])

    found = vectors.select("_id", "_m", "_codes", "_tfs").mapInArrow(run, "_at long, doc_id long, score long")
    order = Window.partitionBy("_at").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_documents(
    docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", k: int = 20,
    block_bytes: int = 8 << 20, seed_share: int = 32,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of each item with a score above 0, ties by document id.

    Terms are runs of letters, digits and everything outside ASCII, A-Z lower-cased. The score is the sum over the item's
    terms, repeats included, of w times ((10^9 tf) div (1000 tf + 12 m)), w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 75 +
    (25 n N) div L. Items are broadcast in blocks of about ``block_bytes``; the documents are read once a block. One document
    of ``seed_share`` is ranked first, only to have k-th scores to prune with; the search then goes over all of them.

    Each row of either table counts, repeated rows too; a repeated item has its results once for each row. Null texts hold no
    terms, documents without an id take no part in the ranking (but in N, L and df); items without terms have no rows, nor
    has an empty table. Other columns are ignored.
    """
    spark = docs.sparkSession
    numbered = items.select(F.col(f"`{item_key}`").cast("long").alias("item_id"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("_text"))
    # equal rows are ranked once and given out as often as they occur
    numbered = numbered.groupBy("item_id", "_text").agg(F.count("*").alias("_times")).withColumn("_item", F.xxhash64("item_id", "_text"))
    terms = settled(_item_terms(numbered.select("_item", "item_id", "_text")).join(numbered.select("_item", "_times"), "_item"))
    blocks = max(1, -(-int(terms.agg(F.sum(F.octet_length("_term") + 40)).first()[0] or 0) // block_bytes))
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text"))
    out = None
    for block in range(blocks):
        part: dict = {}
        for r in terms.where(F.pmod(F.col("_item"), F.lit(blocks)) == block).collect():  # about block_bytes
            part.setdefault((r["item_id"], r["_item"], r["_times"]), []).append((r["_term"], r["_n"]))
        if not part:
            continue
        words = sorted({t for of in part.values() for t, _ in of})
        vectors = settled(_vectors(rows, words))
        tallies = vectors.where(F.col("_docs").isNotNull())
        total = tallies.agg(F.sum("_docs"), F.sum("_all")).first()
        if not total[0]:
            continue
        df = np.zeros(len(words), np.int64)
        for code, n in tallies.select(F.posexplode("_df").alias("_code", "_n")).groupBy("_code").agg(F.sum("_n")).collect():  # one row a term of the block
            df[code] = n
        weight = np.floor(1000 * np.log((2 * total[0] + 2) / (2 * df + 1))).astype(np.int64)
        code_of = {t: i for i, t in enumerate(words)}
        order, sparse = sorted(part, key=repr), []
        for name in order:
            codes = np.array(sorted(code_of[t] for t, _ in part[name]), np.int64)
            times = {code_of[t]: n for t, n in part[name]}
            sparse.append((codes, weight[codes] * np.array([times[c] for c in codes], np.int64)))
        m = F.expr(f"75 + cast(25 * _n as decimal(18,0)) * cast({total[0]} as decimal(18,0)) div cast({total[1]} as decimal(20,0))")
        ready = vectors.where(F.col("_id").isNotNull() & F.col("_n").isNotNull()).withColumn("_m", m)
        seeds = _ranked(ready.where(F.pmod(F.xxhash64("_id", "_n"), F.lit(seed_share)) == 0), sparse, len(words), np.zeros(len(order), np.int64), k)
        least = np.zeros(len(order), np.int64)
        for at, score in seeds.where(F.col("rank") == k).select("_at", "score").collect():  # one row an item of the block
            least[at] = score
        names = spark.createDataFrame([(i, *n) for i, n in enumerate(order)], "_at long, item_id long, _item long, _times long")
        found = _ranked(ready, sparse, len(words), least, k).join(names, "_at")
        found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
        found = found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
