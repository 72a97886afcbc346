"""Score documents by the difference of their cross-entropies under two matched bigram models.

Both models share one vocabulary: every word of the documents. The target model
counts the bigrams of target documents, the background model those of all
documents, scaled to the target's number of words. A document's score is the mean
over its words of the loss under the target model minus the loss under the
background model.

The counts are a distributed table. Documents are packed into chunks where they are
read; the keys of the chunks are joined with those of the targets, and only the
places of target documents come back to their chunks. Each chunk
sends every key it holds (a word, a word before another, a bigram) once, in buckets
of the key space, where the counts of all chunks are added up and sent back to the
chunks that asked. So a frequent bigram makes one entry per chunk, and nothing that
grows with the words reaches the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewarden.llm.common import Words, chunks, mixed_bits, ranges, settled, word_table

_TABLE = word_table(kinds=True)
_TABLE[_TABLE == 2] = 0  # marks part words
#: Words of a chunk, and about how many entries a bucket holds; a row has at least LEAST_KEYS, so that rows grow with the input.
CHUNK_WORDS, BUCKET_ENTRIES, LEAST_BUCKETS, LEAST_KEYS = 3 << 20, 1 << 20, 64, 64
#: The last two bits of a key say what it counts.
_WORD, _BEFORE, _PAIR = (np.uint64(k) for k in range(3))
_KIND = np.uint64(3)
_START, _OTHER = np.uint64(0x5BD1E995A3C59AC3), np.uint64(0x27D4EB2F165667C5)


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, n): how often each word, as a hash of its lower-case form, occurs in the documents."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = ranges(batch.column(0))
            for start, stop in chunks(offsets, 1 << 20):
                words, n = np.unique(Words(data, offsets[start: stop + 1], _TABLE, fold=True).hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    return docs.select(text).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, text: str, size: int) -> np.ndarray:
    """Sorted hashes of the ``size`` most frequent words; ties go to the smaller hash."""
    rows = word_counts(docs, text).orderBy(F.desc("n"), "word").limit(size).select("word").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def _packed(array: np.ndarray) -> bytes:
    """Whole numbers as compressed bytes, the bytes of one rank together."""
    return zlib.compress(np.ascontiguousarray(array.view(np.uint8).reshape(-1, array.itemsize).T).tobytes(), 1)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


_CHUNK = "_chunk long, _keys array<long>, _sizes binary, _words binary, _places binary, n_words long, n_keys long"


def packed_chunks(docs: DataFrame, words: np.ndarray | None) -> DataFrame:
    """Chunks of the documents (_key, _text): their keys, numbers of words, and words as places in the chunk's own list.

    With ``words``, a sorted list of hashes, all other words are one.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes, hashes, held, made = [], [], [], 0, 0
        part = TaskContext.get().partitionId()

        def chunk() -> pa.RecordBatch:
            n, every = np.concatenate(sizes), np.concatenate(hashes)
            hashes.clear()
            own, place, count = np.unique(every, return_inverse=True, return_counts=True)
            order = np.argsort(-count, kind="stable")  # small places for frequent words compress
            rank = np.empty(len(own), np.uint32)
            rank[order] = np.arange(len(own), dtype=np.uint32)
            places, own, n_words = rank[place], own[order], len(every)
            del every, place, rank, count, order
            values = [part + (made << 32), pa.concat_arrays(keys).to_pylist(), n.tobytes(), _packed(own), _packed(places), n_words, len(_Counts(own, places, n).keys)]
            types = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 3, *[pa.int64()] * 2]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=[c.split()[0] for c in _CHUNK.split(", ")])

        for batch in batches:
            data, offsets = ranges(batch.column(1))
            for start, stop in chunks(offsets):
                found = Words(data, offsets[start: stop + 1], _TABLE, fold=True)
                now = found.hashes
                if words is not None:
                    now = np.where(np.isin(now, words), now, _OTHER)
                keys.append(batch.column(0).slice(start, stop - start))
                sizes.append(np.bincount(found.doc, minlength=stop - start).astype(np.int64))
                hashes.append(now)
                held += len(now) + stop - start  # empty documents fill a chunk too
                if held >= CHUNK_WORDS:
                    yield chunk()
                    keys, sizes, hashes, held, made = [], [], [], 0, made + 1
        if keys:
            yield chunk()

    return docs.select("_key", "_text").mapInArrow(run, _CHUNK)


class _Counts:
    """The different keys of a chunk in order, their counts in all documents and in those at the places ``target``, and where each word finds its three keys."""

    def __init__(self, own: np.ndarray, places: np.ndarray, sizes: np.ndarray, target: list[int] | None = None):
        now = own[places]
        before = np.empty_like(now)
        before[1:] = now[:-1]
        before[(np.cumsum(sizes) - sizes)[sizes > 0]] = _START
        self.row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        chosen = np.zeros(len(sizes), bool)
        chosen[target or []] = True
        wanted = chosen[self.row]
        keys, n, n_target, at = [], [], [], []
        # one kind at a time, so that only one has its working arrays
        for kind, of in ((_WORD, lambda: now), (_BEFORE, lambda: mixed_bits(before + np.uint64(1))), (_PAIR, lambda: mixed_bits(mixed_bits(before) * np.uint64(31) + now))):
            key, place, count = np.unique((of() & ~_KIND) | kind, return_inverse=True, return_counts=True)
            place = place.astype(np.int32)
            keys.append(key)
            n.append(count)
            n_target.append(np.bincount(place[wanted], minlength=len(key)))
            at.append(place)
        every = np.concatenate(keys)
        order = np.argsort(every)
        spot = np.empty(len(every), np.int32)
        spot[order] = np.arange(len(every), dtype=np.int32)
        self.keys, self.n, self.n_target = every[order], np.concatenate(n)[order], np.concatenate(n_target)[order]
        shift = np.cumsum([0, *map(len, keys)])
        self.word, self.before, self.pair = (spot[s: s + len(k)][p] for s, k, p in zip(shift, keys, at, strict=False))


def _counted(row: dict, target: list[int] | None = None) -> _Counts:
    return _Counts(_unpacked(row["_words"], np.uint64), _unpacked(row["_places"], np.uint32), np.frombuffer(row["_sizes"], np.int64), target)


def target_places(packs: DataFrame, targets: DataFrame) -> DataFrame:
    """(_chunk, _target): the places of the documents of a chunk whose key ``targets`` (_key) has, for chunks with any."""
    members = packs.select("_chunk", F.posexplode("_keys").alias("_place", "_key")).where("_key is not null")
    # the targets grow with the documents: the same join at every size
    return members.join(targets.hint("merge"), "_key").groupBy("_chunk").agg(F.collect_list("_place").alias("_target"))


def key_totals(packs: DataFrame, places: DataFrame, buckets: int) -> DataFrame:
    """(_chunk, _bucket, _totals, n_words, n_target): the counts over all chunks of the keys of a chunk in a bucket, in order.

    ``n_words`` and ``n_target`` are the different words of the bucket and their number in target documents, on the row of its first chunk.
    """
    import pyarrow as pa

    bits = np.uint64(64 - (buckets.bit_length() - 1))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = (None, None)
        for batch in batches:
            for row in batch.to_pylist():
                if row["_sizes"] is None:
                    marks = row["_chunk"], row["_target"]
                    continue
                c = _counted(row, marks[1] if marks[0] == row["_chunk"] else None)
                edges = np.searchsorted((c.keys >> bits).astype(np.int64), np.arange(buckets + 1))
                full = np.flatnonzero(edges[1:] > edges[:-1])
                # the steps between sorted keys are shorter than the keys
                steps = pa.array([_packed(np.diff(c.keys[edges[b]: edges[b + 1]], prepend=np.uint64(0))) for b in full], pa.binary())
                counts = pa.array([_packed(np.r_[c.n_target[edges[b]: edges[b + 1]], c.n[edges[b]: edges[b + 1]]].astype(np.uint32)) for b in full], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(full), row["_chunk"], np.int64)), pa.array(full.astype(np.int64)), steps, counts], names=["_chunk", "_bucket", "_hashes", "_counts"])

    def added(rows: list[dict]) -> pa.RecordBatch:
        keys = [np.cumsum(_unpacked(r["_hashes"], np.uint64), dtype=np.uint64) for r in rows]
        counts = [_unpacked(r["_counts"], np.uint32).reshape(2, -1) for r in rows]
        own, place = np.unique(np.concatenate(keys), return_inverse=True)
        both = np.concatenate(counts, 1)
        totals = np.stack([np.bincount(place, c, len(own)) for c in both]).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        answers = [_packed(totals[:, place[e - len(k): e]].reshape(-1)) for e, k in zip(ends, keys, strict=True)]
        first, in_target = np.zeros((2, len(rows)), np.int64)
        words = (own & _KIND) == _WORD
        first[0], in_target[0] = words.sum(), totals[0][words].sum()
        return pa.RecordBatch.from_arrays([
            pa.array([r["_chunk"] for r in rows], pa.int64()), pa.array([r["_bucket"] for r in rows], pa.int64()), pa.array(answers, pa.binary()), pa.array(first), pa.array(in_target)],
            names=["_chunk", "_bucket", "_totals", "n_words", "n_target"])

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and rows[0]["_bucket"] != row["_bucket"]:
                    yield added(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield added(rows)

    marked = places.select("_chunk", F.lit(0).alias("_order"), "_target").unionByName(
        packs.select("_chunk", F.lit(1).alias("_order"), "_sizes", "_words", "_places"), allowMissingColumns=True)
    entries = _dealt(marked, "_chunk").sortWithinPartitions("_chunk", "_order").select("_chunk", "_target", "_sizes", "_words", "_places").mapInArrow(
        sent, "_chunk long, _bucket long, _hashes binary, _counts binary")
    return _dealt(entries, "_bucket").sortWithinPartitions("_bucket").mapInArrow(
        grouped, "_chunk long, _bucket long, _totals binary, n_words long, n_target long")


def _dealt(df: DataFrame, number: str) -> DataFrame:
    """Rows of the same number together, consecutive numbers in different partitions."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionById(parts, F.pmod(F.col(number), F.lit(parts)).cast("int"))


def cross_entropy_difference(
    docs: DataFrame, targets: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary_size: int | None = None, prior: float = 50.0,
) -> DataFrame:
    """One row per document: ``key``, n_words, target_loss, background_loss, difference (bits per word; low is near the target).

    ``targets`` has the keys of the target documents. Counts cover every word and every bigram of every document; only with
    a ``vocabulary_size`` are all but so many most frequent words one class. A bigram's count is backed by ``prior`` words
    drawn from the add-one unigram model. Words are runs of letters, digits and bytes beyond ASCII in lower case. Null texts
    and texts without words have losses of 0. A null key is in no target; a repeated key of ``targets`` counts once; repeated
    rows are documents of their own; other columns are left out; an empty table gives no rows.
    """
    import pyarrow as pa
    if vocabulary_size is not None and vocabulary_size <= 0:
        raise ValueError("vocabulary_size must be above 0")
    words = None if vocabulary_size is None else vocabulary(docs, text, vocabulary_size)
    packs = settled(packed_chunks(docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text")), words))
    places = target_places(packs, targets.select(F.col(key).cast("long").alias("_key")).dropna().distinct())
    sums = packs.agg(F.sum("n_words").alias("all"), F.sum("n_keys").alias("keys"), F.max("n_keys").alias("most")).first()
    n_all, most = sums["all"] or 0, max(1, sums["most"] or 0)
    buckets = LEAST_BUCKETS
    while buckets * BUCKET_ENTRIES < (sums["keys"] or 0) and buckets * LEAST_KEYS < most:
        buckets *= 2
    totals = settled(key_totals(packs, places, buckets))
    found = totals.agg(F.sum("n_words").alias("words"), F.sum("n_target").alias("target")).first()
    n_target = found["target"] or 0
    different = (found["words"] or 0) if words is None else len(words)
    scale = n_target / n_all if n_target else 1.0

    def loss(n: np.ndarray, c: _Counts, factor: float, total: float) -> np.ndarray:
        single = (n[c.word] * factor + 1) / (total * factor + different + 2)
        return -np.log2((n[c.pair] * factor + prior * single) / (n[c.before] * factor + prior))

    def scored(row: dict, parts: list[bytes]) -> pa.RecordBatch:
        c = _counted(row)
        got = [_unpacked(p, np.int64).reshape(2, -1) for p in parts]
        near, far = np.concatenate(got, 1) if got else np.zeros((2, 0), np.int64)
        n = np.frombuffer(row["_sizes"], np.int64)
        a, b = (np.bincount(c.row, x, len(n)) / np.maximum(n, 1) for x in (loss(near, c, 1.0, n_target), loss(far, c, scale, n_all)))
        return pa.RecordBatch.from_arrays(
            [pa.array(row["_keys"], pa.int64()), pa.array(n), pa.array(a), pa.array(b), pa.array(a - b)], names=["_key", "n_words", "target_loss", "background_loss", "difference"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, parts = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["_bucket"] < 0:
                    if row:
                        yield scored(row, parts)
                    row, parts = r, []
                else:
                    parts.append(r["_totals"])
        if row:
            yield scored(row, parts)

    pack = F.struct("_keys", "_sizes", "_words", "_places")
    back = packs.select("_chunk", F.lit(-1).cast("long").alias("_bucket"), pack.alias("_pack")).unionByName(
        totals.select("_chunk", "_bucket", "_totals"), allowMissingColumns=True).select("_chunk", "_bucket", "_totals", "_pack.*")
    return _dealt(back, "_chunk").sortWithinPartitions("_chunk", "_bucket").mapInArrow(
        run, "_key long, n_words long, target_loss double, background_loss double, difference double").withColumnRenamed("_key", key)
