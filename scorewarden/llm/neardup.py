"""N-gram Jaccard join with Bayesian pruning of candidates.

Texts are sets of word shingles. Sets that agree on a band of MinHash values are
candidates. Their MinHash values are compared a few at a time, and a pair is
dropped as soon as the posterior probability that its similarity reaches the
threshold falls below a tolerance. What is left is verified exactly. Large groups
are worked through in blocks, and only counts per text and a spanning forest
leave a block, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewarden.llm.common import Words, chunks, mixed_bits, ranges, settled, text_key, word_table
from scorewarden.llm.graph import components

_TABLE = word_table()
_SHORT = np.uint64(0x8CB92BA72F3D8DD7)
_OTHER = np.uint64(0xA0761D6478BD642F)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts of one chunk and the row of each, sorted by row and hash.

    A text of fewer than ``n`` words is one shingle of all its words; a text without words has none.
    """
    words = Words(data, offsets, _TABLE)
    value, doc = words.grams(n)
    counts = np.bincount(words.doc, minlength=words.docs)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        first = np.searchsorted(words.doc, short)
        whole = np.zeros(len(short), np.uint64)
        for i in range(n - 1):
            more = counts[short] > i
            whole[more] = mixed_bits(whole[more] * _SHORT + words.hashes[first[more] + i])
        value, doc = np.concatenate([value, whole]), np.concatenate([doc, short])
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[new], doc[new]


def factors(hashes: int) -> np.ndarray:
    return mixed_bits(np.arange(1, hashes + 1, dtype=np.uint64) * _OTHER) | np.uint64(1)


def sketches(texts: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """Per row of (_key, _text): digest _d1, _d2 and size _n of its shingle set, one byte of each MinHash, and band keys."""
    import pyarrow as pa
    multiply = factors(bands * rows)
    schema = "_key long, _k1 long, _k2 long, _d1 long, _d2 long, _n long, _sig binary, _bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = ranges(batch.column(1))
            for start, stop in chunks(offsets):
                value, doc = shingle_sets(data, offsets[start: stop + 1], n)
                size = np.bincount(doc, minlength=stop - start)
                d1, d2 = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
                least = np.zeros((len(size), len(multiply)), np.uint64)
                some = np.flatnonzero(size)
                if len(some):
                    at = np.searchsorted(doc, some)
                    d1[some] = np.add.reduceat(mixed_bits(value), at)
                    d2[some] = np.add.reduceat(mixed_bits(value ^ _OTHER), at)
                    for i, m in enumerate(multiply):
                        least[some, i] = np.minimum.reduceat(value * m, at)
                least = mixed_bits(least)
                keys = np.zeros((len(size), bands), np.uint64)
                for i in range(rows):
                    keys = mixed_bits(keys * _SHORT + least[:, i::rows])
                keys = mixed_bits(keys + np.arange(bands, dtype=np.uint64) * _OTHER)
                sig = (least & np.uint64(255)).astype(np.uint8)
                width = pa.array(np.arange(0, len(size) + 1, dtype=np.int32) * bands)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(i).slice(start, stop - start) for i in (0, 2, 3)), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                    pa.array(size.astype(np.int64)), pa.array([s.tobytes() for s in sig], pa.binary()),
                    pa.ListArray.from_arrays(width, pa.array(keys.view(np.int64).ravel())),
                ], names=["_key", "_k1", "_k2", "_d1", "_d2", "_n", "_sig", "_bands"])

    return texts.select("_key", "_text", *text_key(F.col("_text"))).mapInArrow(run, schema)


def least_matches(hashes: int, threshold: float, tolerance: float, step: int = 32) -> list[tuple[int, int]]:
    """(compared, fewest matches): below that the posterior of reaching the threshold is under ``tolerance``.

    With a uniform prior the posterior after m of n matches is a binomial tail. One byte of a MinHash also matches by
    chance once in 256.
    """
    p = threshold + (1 - threshold) / 256
    out = []
    for n in range(step, hashes + 1, step):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * p ** m * (1 - p) ** (n + 1 - m)
        out.append((n, m))
    return out


def likely(sigs: np.ndarray, i: np.ndarray, j: np.ndarray, plan: list[tuple[int, int]]) -> np.ndarray:
    """Positions of the pairs (i, j) that are not dropped."""
    alive, seen, done = np.arange(len(i)), np.zeros(len(i), np.int32), 0
    for n, fewest in plan:
        for part in range(0, len(alive), 1 << 16):
            s = slice(part, part + (1 << 16))
            seen[s] += (sigs[i[alive[s]], done:n] == sigs[j[alive[s]], done:n]).sum(1)
        keep = seen >= fewest
        alive, seen, done = alive[keep], seen[keep], n
    return alive


def forest(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For every entry of ``ids`` the smallest id it is connected with through the pairs (i, j)."""
    root = np.asarray(ids).copy()
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        if (root == before).all():
            break
    return root


def joined(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that the links (a, b) touch, and for each the smallest id it is connected with."""
    ids = np.unique(np.concatenate([a, b]))
    return ids, forest(ids, np.searchsorted(ids, a), np.searchsorted(ids, b))


def triangle(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs inside groups of consecutive rows: groups of one size at once, large ones alone."""
    for n in np.unique(sizes[(sizes > 1) & (sizes <= 24)]):
        a, b = np.triu_indices(n, 1)
        base = starts[sizes == n]
        for part in range(0, len(base), 512):
            at = base[part: part + 512, None]
            yield (at + a).ravel(), (at + b).ravel()
    for at, n in zip(starts[sizes > 24], sizes[sizes > 24], strict=True):
        a, b = np.triu_indices(n, 1)
        yield at + a, at + b


def block_keys(df: DataFrame, group: str, members: str, block: int, node: str = "_id") -> DataFrame:
    """Add ``_unit`` and ``_side``: a group of up to ``block`` rows is one unit, a larger one a unit per pair of its blocks.

    Side 2 marks a unit inside one block; pairs of a unit of sides 0 and 1 count only across the sides.
    """
    blocks = F.ceil(F.col(members) / block).cast("int")
    own = F.pmod(F.xxhash64(F.lit(3), F.col(node)), blocks).cast("int")
    unit = F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.struct(
        F.xxhash64(F.col(group), F.least(own, other), F.greatest(own, other)).alias("_unit"),
        F.when(other == own, 2).when(own < other, 0).otherwise(1).alias("_side")))
    return df.withColumn("_u", F.explode(unit)).select("*", "_u.*").drop("_u")


def in_packs(df: DataFrame, rows: int, work, schema: str) -> DataFrame:
    """Apply ``work`` to packs of about ``rows`` rows that hold whole units, sorted by unit."""
    packs = max(1, -(-df.count() // rows))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_unit", kind="stable").reset_index(drop=True)
        unit = part["_unit"].to_numpy()
        starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
        return work(part, starts, np.diff(np.r_[starts, len(part)]))

    return df.withColumn("_pack", F.pmod("_unit", F.lit(packs))).groupBy("_pack").applyInPandas(run, schema)


def candidate_groups(sets: DataFrame, threshold: float, tolerance: float, hashes: int, block: int) -> DataFrame:
    """(node, root) of the sets (_id, _sig, _bands) that some chain of likely pairs connects."""
    in_band = sets.select("_id", F.explode("_bands").alias("_band"))
    buckets = in_band.groupBy("_band").agg(
        F.count("*").alias("_members"), F.bit_xor(F.xxhash64("_id")).alias("_x"), F.bit_xor(F.xxhash64(F.lit(1), "_id")).alias("_y"),
    ).where("_members > 1")
    # bands with the same members say the same
    buckets = buckets.groupBy("_members", "_x", "_y").agg(F.min("_band").alias("_band")).select("_band", "_members")
    rows = settled(block_keys(in_band.join(buckets, "_band"), "_band", "_members", block).select("_id", "_unit", "_side").join(
        sets.select("_id", "_sig"), "_id"))
    plan = least_matches(hashes, threshold, tolerance)

    def prune(part: pd.DataFrame, starts: np.ndarray, sizes: np.ndarray) -> pd.DataFrame:
        sigs = np.frombuffer(b"".join(part["_sig"]), np.uint8).reshape(len(part), hashes)
        ids, side = part["_id"].to_numpy(), part["_side"].to_numpy()
        left, right = [], []
        for i, j in triangle(starts, sizes):
            across = (side[i] != side[j]) | (side[i] == 2)
            i, j = i[across], j[across]
            alive = likely(sigs, i, j, plan)
            low = forest(np.arange(len(part)), i[alive], j[alive]) if len(alive) else np.zeros(0, np.int64)
            moved = np.flatnonzero(low != np.arange(len(low)))
            left.append(ids[moved])
            right.append(ids[low[moved]])
        # one link per id and pack, whatever the number of bands that show it
        a, b = joined(np.concatenate([*left, np.zeros(0, np.int64)]), np.concatenate([*right, np.zeros(0, np.int64)]))
        return pd.DataFrame({"a": a, "b": b})[a != b]

    return components(in_packs(rows, 40_000, prune, "a long, b long"))


def shared(values: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, by products of slices of the incidence matrix."""
    sizes = [len(v) for v in values]
    everything = np.concatenate(values)
    row = np.repeat(np.arange(len(values)), sizes)
    _, column, counts = np.unique(everything, return_inverse=True, return_counts=True)
    wide = counts > 1
    place = np.cumsum(wide) - 1
    keep = wide[column]
    row, column = row[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(values), len(values)), np.float32)
    width = 4096
    for low in range(0, int(wide.sum()), width):
        s = slice(*np.searchsorted(column, [low, low + width]))
        part = np.zeros((len(values), width), np.float32)
        part[row[s], column[s] - low] = 1
        out += part @ part.T
    return out


def verified(sets: DataFrame, threshold: float) -> DataFrame:
    """Per unit and set (_id, _unit, _side, _set): _links with similarity of at least ``threshold``, and _root."""
    def check(part: pd.DataFrame, starts: np.ndarray, sizes: np.ndarray) -> pd.DataFrame:
        ids, side = part["_id"].to_numpy(), part["_side"].to_numpy()
        links, root = np.zeros(len(part), np.int64), ids.copy()
        for at, n in zip(starts, sizes, strict=True):
            if n < 2:
                continue
            s = slice(at, at + n)
            values = [np.frombuffer(v, np.uint64) for v in part["_set"].iloc[s]]
            count = np.array([len(v) for v in values])
            both = shared(values) if n > 2 else np.full((2, 2), len(np.intersect1d(*values, assume_unique=True)), float)
            both = both.astype(np.float64)
            near = both >= threshold * (count[:, None] + count[None] - both) - 1e-6
            near &= (side[s][:, None] != side[s][None]) | (side[s] == 2)[:, None]
            np.fill_diagonal(near, False)
            links[s] = near.sum(1)
            i, j = np.nonzero(np.triu(near, 1))
            root[s] = forest(ids[s], i, j)
        known, least = joined(ids, root)
        return pd.DataFrame({"_id": ids, "_links": links, "_root": least[np.searchsorted(known, ids)]})

    return in_packs(sets, 4_000, check, "_id long, _links long, _root long")


def _shingles(rows: DataFrame, n: int) -> DataFrame:
    """Replace _text by _set, its sorted shingle hashes as bytes."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = ranges(batch.column(1))
            for start, stop in chunks(offsets):
                value, doc = shingle_sets(data, offsets[start: stop + 1], n)
                edge = np.searchsorted(doc, np.arange(stop - start + 1))
                sets = [value[edge[i]: edge[i + 1]].tobytes() for i in range(stop - start)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(sets, pa.binary())], names=["_id", "_set"])

    return rows.select("_id", "_text").mapInArrow(run, "_id long, _set binary")


def classified(docs: DataFrame, *, key: str, text: str, words: int, threshold: float, bands: int, rows: int, tolerance: float, block: int) -> DataFrame:
    """Per document (_key, _k1, _k2): _n, _class (null without words), class_id, n_links, n_copies; see ``near_duplicates``."""
    texts = docs.select(F.col(key).cast("long").alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
    sketched = settled(sketches(texts, words, bands, rows))
    sets = settled(
        sketched.where("_n > 0").groupBy("_d1", "_d2").agg(
            F.min("_key").alias("_least"), F.count("*").alias("_copies"),
            F.min(F.struct("_k1", "_k2", "_n", "_sig", "_bands")).alias("_s"))
        .select("_d1", "_d2", "_least", "_copies", "_s.*").withColumn("_id", F.monotonically_increasing_id()))
    groups = candidate_groups(sets, threshold, tolerance, bands * rows, block)
    # Members of a group differ in size by a factor of at most 1 / threshold where they are linked: large groups are cut
    # into classes of size, and a class only meets itself and the next one.
    width = -math.log(threshold)
    placed = settled(
        sets.select("_id", "_k1", "_k2", "_n").join(groups.withColumnRenamed("node", "_id"), "_id")
        .withColumn("_class", F.floor(F.log("_n") / F.lit(width)).cast("int")))
    whole = placed.groupBy("root").agg(F.count("*").alias("_all"))
    small = placed.join(whole.where(F.col("_all") <= block).select("root"), "root").select(
        "_id", "_k1", "_k2", F.xxhash64("root").alias("_unit"), F.lit(2).alias("_side"))
    large = placed.join(whole.where(F.col("_all") > block).select("root"), "root")
    sizes = large.groupBy("root", "_class").agg(F.count("*").alias("_members"))
    inner = block_keys(
        large.join(sizes, ["root", "_class"]).withColumn("_g", F.xxhash64("root", "_class")), "_g", "_members", block,
    ).select("_id", "_k1", "_k2", "_unit", "_side")
    # each block of a class with each block of the next class
    mine, theirs = F.ceil(F.col("_members") / block).cast("int"), F.ceil(F.col("_others") / block).cast("int")
    own = F.pmod(F.xxhash64(F.lit(3), "_id"), mine).cast("int")
    meets = []
    for step in (1, -1):
        other = sizes.select("root", (F.col("_class") - step).alias("_class"), F.col("_members").alias("_others"))
        low = F.col("_class") if step == 1 else F.col("_class") - 1
        pair = (lambda o: F.xxhash64(F.lit(7), "root", low, own, o)) if step == 1 else (lambda o: F.xxhash64(F.lit(7), "root", low, o, own))
        meets.append(
            large.join(sizes, ["root", "_class"]).join(other, ["root", "_class"])
            .withColumn("_unit", F.explode(F.transform(F.sequence(F.lit(0), theirs - 1), pair)))
            .select("_id", "_k1", "_k2", "_unit", F.lit(0 if step == 1 else 1).alias("_side")))
    units = settled(small.unionByName(inner).unionByName(meets[0]).unionByName(meets[1]))
    wanted = units.select("_id", "_k1", "_k2").dropDuplicates(["_id"])
    bodies = texts.select(*text_key(F.col("_text")), "_text").groupBy("_k1", "_k2").agg(F.first("_text").alias("_text")).join(wanted, ["_k1", "_k2"])
    links = settled(verified(settled(units.select("_id", "_unit", "_side").join(_shingles(bodies, words), "_id")), threshold))
    connected = components(links.where("_id != _root").select(F.col("_id").alias("a"), F.col("_root").alias("b")))
    counts = links.groupBy("_id").agg(F.sum("_links").alias("n_links"))
    known = (
        sets.select("_d1", "_d2", "_id", "_least", "_copies").join(counts, "_id", "left")
        .join(connected.withColumnRenamed("node", "_id"), "_id", "left").withColumn("_class", F.coalesce("root", "_id")))
    classes = known.groupBy("_class").agg(F.min("_least").alias("class_id"))
    found = known.join(classes, "_class").select(
        "_d1", "_d2", "_class", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("_copies").alias("n_copies"))
    alone = sketched.where("_n = 0").selectExpr(
        "_key", "_k1", "_k2", "_n", "cast(null as long) as _class", "_key as class_id", "0L as n_links", "1L as n_copies")
    return sketched.where("_n > 0").select("_key", "_k1", "_k2", "_n", "_d1", "_d2").join(found, ["_d1", "_d2"]).drop("_d1", "_d2").unionByName(alone)


def near_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 5, threshold: float = 0.8, bands: int = 32, rows: int = 4,
    tolerance: float = 1e-6, block: int = 256,
) -> DataFrame:
    """One row per document: ``key``, class_id, n_links, n_copies.

    Documents whose sets of ``words``-word shingles have a Jaccard similarity of at least ``threshold`` are linked, and
    ``class_id`` is the smallest key among the documents that links connect. ``n_copies`` counts the documents with the
    same set, itself included; ``n_links`` counts the different sets that its set is linked with, so copies are not
    expanded into pairs. A pair exactly at 0.8 is missed by all 32 bands of 4 with a chance of 5e-8.

    Words are separated by space and the control characters 9 to 13. A text of fewer words is one shingle; null texts and
    texts without words link to nothing and are each a class of their own. Repeated rows are copies. A null key takes part;
    a class without any key has a null ``class_id``. Other columns are left out; an empty table gives no rows.
    """
    found = classified(
        docs, key=key, text=text, words=words, threshold=threshold, bands=bands, rows=rows, tolerance=tolerance, block=block)
    return found.select(F.col("_key").alias(key), "class_id", "n_links", "n_copies")


def one_of_each(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 5, threshold: float = 0.8, bands: int = 32, rows: int = 4,
    tolerance: float = 1e-6, block: int = 256,
) -> DataFrame:
    """The documents, with all their columns, that stay when each class of ``near_duplicates`` keeps one.

    The one with the smallest key stays, nulls first, then the smallest text key; of repeated rows one stays. Documents
    without words are no duplicates of each other and all stay. Columns may have any name.
    """
    found = settled(classified(
        docs, key=key, text=text, words=words, threshold=threshold, bands=bands, rows=rows, tolerance=tolerance, block=block))
    this = F.struct("_key", "_k1", "_k2")
    kept = found.where("_n > 0").groupBy("_class").agg(F.min(this).alias("_this")).select("_this", F.lit(True).alias("_once"))
    kept = kept.unionByName(found.where("_n = 0").select(this.alias("_this"), F.lit(False).alias("_once")).distinct())
    this = F.struct(F.col(key).cast("long").alias("_key"), *text_key(F.coalesce(F.col(text), F.lit(""))))
    # the row travels as one value, so that no name of its columns can clash
    placed = docs.select(F.struct("*").alias("_row"), this.alias("_this")).join(kept, "_this").withColumn(
        "_place", F.expr("row_number() over (partition by _this order by _once)"))
    return placed.where("_place = 1 or not _once").select("_row.*")
