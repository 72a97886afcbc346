"""Find byte strings of a given length that occur twice, by a radix sort of suffixes cut off at that depth.

A suffix only matters through its first ``length`` bytes, its window. The passes
refine groups of suffixes by more and more of the window and drop whoever is
alone, so that after the last pass the groups are exactly the repeated windows:

1. Every window is led by its smallest hashed 32-byte gram, the digit of the
   first pass. Neighbouring windows with one leader form a run, handled as one row.
   Leaders that occur once are dropped.
2. Runs are compared whole, from the first byte of their first window to the last
   of their last. A run that occurs twice is settled.
3. A repeated window reaches at least a given way to the left or to the right of
   its leader. Runs that agree with no other on either reach are dropped.
4. What is left is cut into cells of neighbouring windows and grouped by the bytes
   that all windows of a cell share, then by all bytes of the cell.
5. Inside the groups that remain, single windows are told apart by the few bytes
   in which windows of a cell differ.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewarden.llm.common import prefix_sums, ranges, settled, span_hashes, text_key
from scorewarden.llm.linededup import shared_folder
from scorewarden.storage import left_lookup

_LOW = np.uint64((1 << 32) - 1)
_TEXT = ["_k1", "_k2"]
#: Leaders of at least one run in so many are hot.
HOT_SHARE = 10_000
#: Texts that a task and its Python worker hold at once.
BATCH_TEXTS = 500


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Whatever is computed inside sends at most ``BATCH_TEXTS`` rows at once to Python: whole texts are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, min(BATCH_TEXTS, int(before)) if int(before) > 0 else BATCH_TEXTS)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def leaders(sums: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first, last) of the leading grams of a text of at least ``length`` bytes.

    Windows that begin at ``first`` to ``last`` are led by the gram at ``place``: the smallest hash, leftmost on ties, a
    choice that depends on the bytes of the window alone.
    """
    n = len(sums) - 1
    at = np.arange(n - gram + 1)
    value = span_hashes(sums, at, at + gram)
    order = (value & ~_LOW) | at.astype(np.uint64)
    width = length - gram + 1
    count = len(order) - width + 1
    blocks = -(-len(order) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(order)] = order
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(behind[:count], ahead[width - 1: width - 1 + count]) & _LOW).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], count] - 1
    return value[place[first]], place[first], first, last


def _digests(parts: list[bytes], size: int) -> np.ndarray:
    """One 64-bit number per part for ``size`` 8, two for 16."""
    raw = b"".join(hashlib.blake2b(p, digest_size=size).digest() for p in parts)
    return np.frombuffer(raw, np.int64).reshape(len(parts), size // 8)


def packed(texts: DataFrame, *columns: str) -> DataFrame:
    """The columns and _body, the bytes of _text compressed: what moves when texts are brought together by their key."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor
        press = ZstdCompressor(level=3).compress
        for batch in batches:
            data, offsets = ranges(batch.column(len(columns)))
            for at in range(0, batch.num_rows, 1000):
                stop = min(at + 1000, batch.num_rows)
                bodies = pa.array([press(data[offsets[i]: offsets[i + 1]].tobytes()) for i in range(at, stop)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(at, stop - at) for c in range(len(columns))), bodies], names=[*columns, "_body"])

    return texts.select(*columns, "_text").mapInArrow(run, texts.select(*columns).schema.add("_body", "binary"))


@contextmanager
def text_table(texts: DataFrame) -> Iterator[DataFrame]:
    """(_k1, _k2, _key, _body, _copies) of each different text of rows (_key, _text, _k1, _k2), in a table bucketed by its key.

    The texts move once, when the table is written; joins by their key then meet them where they lie. ``_key`` is that of
    one of the rows. The table has a database of its own in the shared folder and is gone afterwards, so what is read from
    it must have been settled.
    """
    spark = texts.sparkSession
    database = f"texts_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(spark, 'texts')}'")
    try:
        each = packed(texts, "_key", *_TEXT).groupBy(*_TEXT).agg(F.first(F.struct("_key", "_body")).alias("_one"), F.count("*").alias("_copies"))
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        each.select(*_TEXT, "_one.*", "_copies").write.format("parquet").bucketBy(buckets, *_TEXT).saveAsTable(f"{database}.texts")
        yield spark.table(f"{database}.texts")
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def _by_text(rows: DataFrame, schema: str, work) -> DataFrame:
    """Rows (_k1, _k2, columns of ``work``): per text (_k1, _k2, _text or _body, ...) the arrays that ``work`` makes of its bytes."""
    import pyarrow as pa
    compressed = rows.columns[2] == "_body"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdDecompressor
        plain = ZstdDecompressor().decompress
        for batch in batches:
            data, offsets = (None, None) if compressed else ranges(batch.column(2))
            more = batch.column(3).to_pylist() if batch.num_columns > 3 else [None] * batch.num_rows
            found: list[list] = [[] for _ in names]
            counts, size = [], 0

            def flush():
                row = pa.array(np.repeat([c[0] for c in counts], [c[1] for c in counts]))
                columns = [pa.array(np.concatenate(f)) if isinstance(f[0], np.ndarray) else pa.array([x for part in f for x in part], pa.binary()) for f in found]
                return pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), *columns], names=[*_TEXT, *names])

            for i in range(batch.num_rows):
                text = np.frombuffer(plain(batch.column(2)[i].as_py()), np.uint8) if compressed else data[offsets[i]: offsets[i + 1]]
                made = work(text, more[i])
                if made is None:
                    continue
                for f, m in zip(found, made, strict=True):
                    f.append(m)
                counts.append((i, len(made[0])))
                size += len(made[0])
                if size > 30_000:
                    yield flush()
                    found, counts, size = [[] for _ in names], [], 0
            if counts:
                yield flush()

    return rows.mapInArrow(run, f"_k1 long, _k2 long, {schema}")


def all_leaders(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(_k1, _k2, _lead) of every run."""
    def work(text: np.ndarray, _):
        return None if len(text) < length else (leaders(prefix_sums(text), length, gram)[0].view(np.int64),)
    return _by_text(texts.select(*_TEXT, "_text"), "_lead long", work)


def all_runs(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(_k1, _k2, _lead, _run, _at, _west, _east) of every run: digest of its bytes, packed places, hashes of both reaches.

    With the leader ``back`` bytes into a window, the window holds the ``length`` / 2 + ``gram`` / 2 bytes from the leader
    on, or as many up to its end: ``_east`` and ``_west``, 0 where the text ends before.
    """
    reach = (length - gram) // 2

    def work(text: np.ndarray, _):
        if len(text) < length:
            return None
        sums = prefix_sums(text)
        lead, place, first, last = leaders(sums, length, gram)
        raw = text.tobytes()
        run = _digests([raw[a: b + length] for a, b in zip(first.tolist(), last.tolist(), strict=True)], 8)[:, 0]
        west, east = (np.zeros(len(lead), np.uint64) for _ in range(2))
        low, high = place - reach >= 0, place + length - reach <= len(text)
        west[low] = span_hashes(sums, place[low] - reach, place[low] + gram)
        east[high] = span_hashes(sums, place[high], place[high] + length - reach)
        return lead.view(np.int64), run, (first << 32) | ((place - first) << 16) | (last - first), west.view(np.int64), east.view(np.int64)

    return _by_text(texts.select(*_TEXT, "_text"), "_lead long, _run long, _at long, _west long, _east long", work)


def all_cells(texts: DataFrame, length: int, cell: int) -> DataFrame:
    """(_k1, _k2, _c1, _c2, _h1, _h2, _spot, _left, _right) of the cells of the runs _ats of each text _body.

    Windows are told by how far the leader lies behind their first byte. Cell c holds the distances c * ``cell`` to
    c * ``cell`` + ``cell`` - 1, of which the run has some. _c1, _c2 are a digest of the bytes all windows of the cell
    share, _h1, _h2 of all its bytes and the distances; _left and _right are the bytes beside the shared ones; _spot packs
    the place of the leader and the least and largest distance.
    """
    def work(text: np.ndarray, ats: list[int]):
        raw = text.tobytes()
        cores, hulls, spots, lefts, rights = [], [], [], [], []
        for at in ats:
            first = at >> 32
            place = first + (at >> 16 & 0xFFFF)
            near, far = place - first - (at & 0xFFFF), place - first
            for c in range(near // cell, far // cell + 1):
                low, high = max(near, c * cell), min(far, c * cell + cell - 1)
                start, stop = place - c * cell, place - c * cell - cell + 1 + length
                mark = c.to_bytes(4, "little")
                cores.append(mark + raw[start:stop])
                hulls.append(mark + low.to_bytes(4, "little") + high.to_bytes(4, "little") + raw[place - high: place - low + length])
                spots.append((place << 32) | (low << 16) | high)
                lefts.append(raw[place - high: start])
                rights.append(raw[stop: place - low + length])
        if not cores:
            return None
        c, h = _digests(cores, 16), _digests(hulls, 16)
        return c[:, 0], c[:, 1], h[:, 0], h[:, 1], np.array(spots, np.int64), lefts, rights

    return _by_text(
        texts.select(*_TEXT, "_body", "_ats"), "_c1 long, _c2 long, _h1 long, _h2 long, _spot long, _left binary, _right binary", work)


def _repeated(rows: DataFrame, *by: str) -> DataFrame:
    """The values of ``by`` that more than one row has."""
    return rows.groupBy(*by).agg(F.count("*").alias("_count")).where("_count > 1").select(*by)


def repeated_spans(
    docs: DataFrame, *, text: str = "text", length: int = 400, gram: int = 32, cell: int = 16, stored: DataFrame | None = None,
) -> DataFrame:
    """(_k1, _k2, _spans) for texts that occur once: spans (_start, _stop) of bytes covered by strings of ``length`` bytes
    that start twice, unsorted and overlapping.

    Texts that occur several times are looked at once, as what others may repeat; they themselves repeat as a whole.
    ``stored`` is the ``text_table`` of the texts of at least ``length`` bytes, if there is one.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(*text_key(body), body.alias("_text")).where(F.octet_length("_text") >= length)
    twice = settled(all_leaders(texts, length, gram).groupBy("_lead").agg(F.count("*").alias("_count")).where("_count > 1"))
    # Leaders of at least one run in HOT_SHARE, at most HOT_SHARE of them, are marked in place; their rows are
    # spread at random in the join that drops leaders of a single run.
    total = twice.agg(F.sum("_count")).first()[0] or 0
    hot = twice.where(F.col("_count") * HOT_SHARE >= total).select("_lead", F.lit(True).alias("_hot"))
    marked = all_runs(texts, length, gram).join(F.broadcast(hot), "_lead", "left").withColumn(
        "_by", F.when(F.col("_hot"), F.xxhash64(*_TEXT, "_at")).otherwise(F.col("_lead")))
    cold = twice.where(F.col("_count") * HOT_SHARE < total).select(F.col("_lead").alias("_by"), F.lit(True).alias("_cold"))
    kept = marked.join(cold, "_by", "left").where("_hot or _cold").drop("_by", "_hot", "_cold")
    runs = settled(kept.dropDuplicates([*_TEXT, "_lead", "_at"]))
    first = F.shiftright("_at", 32)
    same = settled(runs.groupBy("_lead", "_run").agg(F.count("*").alias("_count"), F.min(F.struct(*_TEXT, "_at", "_west", "_east")).alias("_one")))
    run_spans = runs.join(same.where("_count > 1").select("_lead", "_run"), ["_lead", "_run"]).select(
        *_TEXT, first.alias("_start"), (first + F.col("_at").bitwiseAND(0xFFFF) + length).alias("_stop"))
    # one run of each kind goes on, if another kind agrees with it on one side of the leader
    kinds = same.select("_lead", "_one.*")
    west, east = (_repeated(kinds.where(f"{side} != 0"), side) for side in ("_west", "_east"))
    ahead = kinds.join(west, "_west", "left_semi").select(*_TEXT, "_at").unionByName(kinds.join(east, "_east", "left_semi").select(*_TEXT, "_at"))
    listed = ahead.groupBy(*_TEXT).agg(F.collect_set("_at").alias("_ats"))
    with nullcontext(stored) if stored is not None else text_table(texts.withColumn("_key", F.lit(None).cast("long"))) as bodies:
        cells = settled(all_cells(bodies.select(*_TEXT, "_body").join(listed, _TEXT), length, cell))
    live = settled(cells.join(_repeated(cells, "_c1", "_c2"), ["_c1", "_c2"]))
    place, low, high = F.shiftright("_spot", 32), F.shiftright("_spot", 16).bitwiseAND(0xFFFF), F.col("_spot").bitwiseAND(0xFFFF)
    # all windows of a cell at once, where all its bytes agree
    whole = settled(_repeated(live, "_h1", "_h2"))
    agree = live.join(whole, ["_h1", "_h2"])
    cell_spans = agree.select(*_TEXT, (place - high).alias("_start"), (place - low + length).alias("_stop"))
    # single windows, of one cell of each kind, where the shared bytes come in several kinds
    shapes = live.select("_c1", "_c2", "_h1", "_h2").distinct()
    several = _repeated(shapes, "_c1", "_c2")
    alone = live.join(whole, ["_h1", "_h2"], "left_anti")
    one_each = alone.select(*live.columns).unionByName(agree.select(*live.columns).dropDuplicates(["_h1", "_h2"])).join(several, ["_c1", "_c2"], "left_semi")
    offset = F.pmod(F.col("_back"), F.lit(cell))
    # hexadecimal text has two characters a byte
    beside = [F.expr("hex(_left)"), F.expr("hex(_right)")]
    single = one_each.select("_c1", "_c2", "_h1", "_h2", *(b.alias(n) for b, n in zip(beside, ("_l", "_r"), strict=True)), high.alias("_high"), low.alias("_low")).withColumn(
        "_back", F.explode(F.sequence("_low", "_high")))
    window = ["_c1", "_c2", "_back", F.right("_l", 2 * offset), F.left("_r", 2 * (F.lit(cell - 1) - offset))]
    single = single.select("_h1", "_h2", F.col("_back").cast("int"), F.xxhash64(*window).alias("_w1"), F.xxhash64(F.lit(1), *window).alias("_w2"))
    hit = single.join(_repeated(single, "_w1", "_w2"), ["_w1", "_w2"]).groupBy("_h1", "_h2").agg(F.min("_back").alias("_near"), F.max("_back").alias("_far"))
    # windows of a cell overlap, so those between the first and the last hit add no byte
    window_spans = live.join(hit, ["_h1", "_h2"]).select(*_TEXT, (place - F.col("_far")).alias("_start"), (place - F.col("_near") + length).alias("_stop"))
    spans = run_spans.unionByName(cell_spans).unionByName(window_spans).select(*_TEXT, F.col("_start").cast("int"), F.col("_stop").cast("int"))
    return spans.groupBy(*_TEXT).agg(F.collect_set(F.struct("_start", "_stop")).alias("_spans"))


def drop_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 400) -> DataFrame:
    """One row per document: ``key``, n_bytes, n_removed, n_spans, _kept (the bytes left).

    Removes every byte covered by a string of ``length`` bytes that also starts elsewhere in the documents, the same
    document included; overlapping starts count, matches never cross documents, and strings are judged on the input.
    Texts count as UTF-8; null and empty texts and texts below ``length`` bytes lose nothing. Repeated rows are copies of
    each other and lose everything from ``length`` bytes on. Other columns are left out; an empty table gives no rows.
    """
    import pyarrow as pa
    body = F.coalesce(F.col(text), F.lit(""))
    every = docs.select(F.col(key).cast("long").alias("_key"), body.alias("_text"), *text_key(body), F.octet_length(body).cast("long").alias("n_bytes"))
    texts = every.where(F.col("n_bytes") >= length)
    schema = "_key long, n_bytes long, n_removed long, n_spans long, _kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdDecompressor
        plain = ZstdDecompressor().decompress
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            lists = batch.column(2)
            edges, flat = lists.offsets.to_numpy(), lists.values
            starts, stops = (flat.field(i).to_numpy() for i in (0, 1))
            valid = lists.is_valid().to_numpy(zero_copy_only=False)
            for i in range(batch.num_rows):
                raw = plain(batch.column(1)[i].as_py())
                sizes.append(len(raw))
                found = []
                if valid[i]:
                    s = slice(edges[i], edges[i + 1])
                    order = np.argsort(starts[s], kind="stable")
                    a, b = starts[s][order], np.maximum.accumulate(stops[s][order])
                    new = np.flatnonzero(np.r_[True, a[1:] > b[:-1]])
                    found = list(zip(a[new].tolist(), b[np.r_[new[1:], len(a)] - 1].tolist(), strict=True))
                at, left = 0, []
                for a, b in found:
                    left.append(raw[at:a])
                    at = b
                kept.append(b"".join([*left, raw[at:]]))
                removed.append(sum(b - a for a, b in found))
                spans.append(len(found))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["_key", "n_bytes", "n_removed", "n_spans", "_kept"])

    with small_batches(docs.sparkSession), text_table(texts) as stored:
        spans = settled(repeated_spans(docs, text=text, length=length, stored=stored))
        single = stored.where("_copies = 1").select(*_TEXT, "_key", "_body").join(spans, _TEXT, "left").select("_key", "_body", "_spans").mapInArrow(run, schema)
        # copies of a text repeat as a whole, so only their keys are looked up; short texts stay where they are
        total = stored.agg(F.sum("_copies")).first()[0] or 1
        copied = stored.where("_copies > 1").select(*_TEXT, "_copies", (F.col("_copies") / total).alias("_share"))
        repeated = left_lookup(texts.select("_key", "n_bytes", *_TEXT), copied, _TEXT, weight="_share").where("_copies is not null")
        whole = repeated.select("_key", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit("").cast("binary").alias("_kept"))
        nothing = F.lit(0).cast("long")
        short = every.where(F.col("n_bytes") < length).select("_key", "n_bytes", nothing.alias("n_removed"), nothing.alias("n_spans"), F.col("_text").cast("binary").alias("_kept"))
        out = settled(single.unionByName(whole).unionByName(short))
    return out.withColumnRenamed("_key", key)
