"""Quality classifier: logistic regression on hashed word n-grams, learned with follow-the-regularised-leader.

A text is cut into words and runs of punctuation; single tokens and pairs of
neighbours are hashed into a fixed number of weights. The score of a text is the
sparse dot product of its scaled counts with the weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewarden.llm.common import Words, chunks, mixed_bits, ranges, word_table

_TABLE = word_table(kinds=True)
_SAME, _PAIR = np.uint64(0x51ED270B2D4F1C35), np.uint64(0x2545F4914F6CDD1D)


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of the texts of one chunk, sorted by row; the squares of a row's values sum to 1.

    Slots of single tokens, of pairs of neighbours, and one slot for a token that repeats the one before it.
    """
    words = Words(data, offsets, _TABLE, fold=True)
    h, doc = words.hashes, words.doc
    inside = doc[1:] == doc[:-1]
    repeat = (h[1:] == h[:-1])[inside]
    pairs = np.where(repeat, _SAME, mixed_bits(h[:-1] * _PAIR + h[1:])[inside])
    rows = np.concatenate([doc, doc[1:][inside]]).astype(np.uint64)
    slots = np.concatenate([h, pairs]) >> np.uint64(64 - bits)
    cells, counts = np.unique((rows << np.uint64(bits)) | slots, return_counts=True)
    row = (cells >> np.uint64(bits)).astype(np.int64)
    totals = np.bincount(row, counts, minlength=words.docs)
    return row, (cells & np.uint64((1 << bits) - 1)).astype(np.int64), np.sqrt(counts / totals[row])


def leader_weights(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, *, epochs: int, rate: float, smooth: float, l1: float, l2: float,
) -> np.ndarray:
    """Weights after FTRL-proximal updates over the rows in order; the last weight is the bias."""
    z, n, w = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(epochs):
        for (slots, values), label in zip(rows, labels, strict=True):
            slots, values = np.append(slots, size), np.append(values, 1.0)
            zs, ns = z[slots], n[slots]
            now = np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((smooth + np.sqrt(ns)) / rate + l2))
            gradient = (1 / (1 + np.exp(-np.clip(now @ values, -35, 35))) - label) * values
            more = ns + gradient * gradient
            z[slots] = zs + gradient - (np.sqrt(more) - np.sqrt(ns)) / rate * now
            n[slots] = more
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((smooth + np.sqrt(n)) / rate + l2))
    return w


def fit(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", bits: int = 18,
    most_rows: int = 20_000, shard_rows: int = 2_500, epochs: int = 4, rate: float = 1.0, smooth: float = 1.0, l1: float = 0.1,
    l2: float = 0.01, seed: int = 5,
) -> np.ndarray:
    """Weights learned from ``labels`` (key, label), which must hold only rows that may be learned from.

    At most about ``most_rows`` labelled rows are used, chosen by a seeded hash of the key; this bound is the size of the
    training sample. Shards of about ``shard_rows`` learn side by side and their weights are averaged, so that what
    reaches the driver is one number per weight at most. Null keys and labels are left out.
    """
    spot = F.xxhash64(F.lit(seed), F.col("_key"))
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).dropna().dropDuplicates(["_key"])
    total = known.count()
    share = min(1.0, most_rows / max(1, total))
    shards = max(1, round(total * share / shard_rows))
    chosen = known.where(F.pmod(spot, F.lit(1 << 30)) < int(share * (1 << 30)))
    # at most about most_rows rows of two numbers
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text")).join(F.broadcast(chosen), "_key")
    rows = rows.withColumns({
        "_shard": F.pmod(F.xxhash64(F.lit(seed + 1), "_key"), F.lit(shards)).cast("int"), "_spot": spot})

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["_spot", "_text"])
        found = []
        for value in part["_text"]:
            data = np.frombuffer(value.encode(), np.uint8)
            _, slots, values = features(data, np.array([0, len(data)], np.int64), bits)
            found.append((slots.astype(np.int32), values.astype(np.float32)))
        w = leader_weights(found, part["_label"].to_numpy(), 1 << bits, epochs=epochs, rate=rate, smooth=smooth, l1=l1, l2=l2)
        at = np.flatnonzero(w)
        return pd.DataFrame({"slot": at, "weight": w[at]})

    learned = rows.groupBy("_shard").applyInPandas(learn, "slot long, weight double")
    mean = learned.groupBy("slot").agg((F.sum("weight") / shards).alias("weight"))
    out = np.zeros((1 << bits) + 1)
    table = mean.toPandas()  # at most 2 ** bits + 1 rows
    out[table["slot"].to_numpy(np.int64)] = table["weight"].to_numpy()
    return out


def score(docs: DataFrame, weights: np.ndarray, *, text: str = "text", name: str = "score") -> DataFrame:
    """Add ``name``, the chance (0 to 1) that a text has label 1; all columns stay. Null and empty texts score the bias.

    An existing column ``name`` is replaced. The weights, a table of fixed size, travel with the function.
    """
    import pyarrow as pa
    bits = (len(weights) - 1).bit_length() - 1
    packed = weights.astype(np.float32)
    kept = [c for c in docs.columns if c != name]
    schema = docs.select(*(f"`{c}`" for c in kept)).schema.add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = ranges(batch.column(kept.index(text)))
            sums = np.zeros(batch.num_rows)
            for start, stop in chunks(offsets):
                row, slots, values = features(data, offsets[start: stop + 1], bits)
                sums[start:stop] = np.bincount(row, packed[slots] * values, minlength=stop - start)
            scores = 1 / (1 + np.exp(-np.clip(sums + packed[-1], -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*kept, name])

    return docs.select(*(f"`{c}`" for c in kept)).mapInArrow(run, schema)


def held_out(key: Column) -> Column:
    """Whether a row's label may not be learned from: crc32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))
