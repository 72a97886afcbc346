"""Mix sources to target weights by fitting word budgets with whole documents.

Documents are counted by exact length. A source first gives as many whole copies
as its budget holds, and where much is left every length gives its share of it,
rounded down, and longer documents close the gap to a small rest. A bounded-knapsack
dynamic programme over the remaining copies of each length fits that rest. Which documents of a length are taken is a
seeded choice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewarden.llm.common import settled

#: A word is a run of anything but space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
_INDEX_BITS = (1 << 33) - 1
#: Most words that one run of the programme may span; it holds four bytes for each.
MOST_SPAN = 1 << 24


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """Rows of (_source, source_size) with ``rank`` from 0 in code point order, null last.

    Range partitions are numbered on their own and shifted by the rows before
    them, so that no task holds all sources.
    """
    parts = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.asc_nulls_last(F.col("_source.source"))
    placed = settled(
        sizes.repartitionByRange(parts, order).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    before = placed.groupBy("_part").count().selectExpr(
        "_part", "coalesce(sum(count) over (order by _part rows between unbounded preceding and 1 preceding), 0) as _before")
    # one row per range partition
    return placed.join(F.broadcast(before), "_part").select(
        "_source", "source_size", (F.col("_before") + F.col("_at").bitwiseAND(_INDEX_BITS)).alias("rank"))


def source_targets(sizes: DataFrame, weights: Sequence[float], most_copies: int) -> DataFrame:
    """Add ``target``: the shares of all words by weight, each at most ``most_copies`` times its source.

    What a capped source leaves is shared again by weight until none is above its cap. Only sums reach the driver.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = settled(ranked_sources(sizes).withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * most_copies))
    level, capped = 0.0, -1
    while True:
        full = F.lit(capped >= 0) & (F.col("_cap") < F.lit(level) * F.col("_weight"))
        row = table.agg(
            F.sum("source_size").alias("all"), F.count(F.when(full, 1)).alias("n"),
            F.sum(F.when(full, F.col("_cap")).otherwise(0)).alias("held"),
            F.sum(F.when(full, 0).otherwise(F.col("_weight"))).alias("open")).first()
        if row["n"] == capped:
            break
        capped = row["n"]
        level = ((row["all"] or 0) - (row["held"] or 0)) / row["open"] if row["open"] else 0.0
    return table.select("_source", "source_size", F.least(F.col("_cap").cast("double"), F.lit(level) * F.col("_weight")).alias("target"))


def fitted_copies(sizes: np.ndarray, counts: np.ndarray, budget: float, most: int, spare: int) -> np.ndarray:
    """How many copies of each length (all above 0) to take, for a sum at or just below ``budget``.

    ``spare`` words are left to the dynamic programme; every length offers ``most`` copies of each document. A small
    source whose whole copies leave a gap that nothing fits is tried with one whole copy less, and a larger one with more
    and more copies of its longest documents given back, up to all of them or ``MOST_SPAN`` words.
    """
    total = int((sizes * counts).sum())
    if not total or budget <= 0:
        return np.zeros(len(sizes), np.int64)
    share = min(budget / total, most)
    order = np.argsort(-sizes, kind="stable")
    best, gap = None, None
    for whole in range(int(np.floor(share)), -1, -1):
        taken = np.full(len(sizes), whole, np.int64) * counts
        even = min(whole + 1, most)
        if budget - whole * total > spare and whole == np.floor(share):  # too much for the programme alone
            taken = np.minimum(np.floor(share * counts).astype(np.int64), most * counts)
            left = int(np.floor(budget)) - int((taken * sizes).sum())
            for i in order:  # at most one more copy of each length
                if taken[i] < even * counts[i] and left - sizes[i] >= spare:
                    taken[i] += 1
                    left -= int(sizes[i])
        left = int(np.floor(budget)) - int((taken * sizes).sum())
        more, open_words = closing_copies(sizes, order, [even * counts - taken, (most - even) * counts], left)
        if best is None or open_words < gap:
            best, gap = taken + more, open_words
        if not gap or total > spare:
            break
    even, room, least = min(int(np.floor(share)) + 1, most) * counts, spare, int(np.floor(budget)) % int(np.gcd.reduce(sizes))
    start, open_first = best, gap
    # no sum comes nearer than ``least``; a small source has been searched in full
    while total > spare and gap > least and room < MOST_SPAN:
        room = min(4 * room, MOST_SPAN)
        taken, left = start.copy(), open_first
        for i in order:
            back = min(int(taken[i]), (room - left) // int(sizes[i])) if left < room else 0
            taken[i] -= back
            left += back * int(sizes[i])
        more, open_words = closing_copies(sizes, order, [np.maximum(even - taken, 0), most * counts - np.maximum(taken, even)], left)
        if open_words < gap:
            best, gap = taken + more, open_words
        if not taken.any():
            break
    return best


def closing_copies(sizes: np.ndarray, order: np.ndarray, limits: Sequence[np.ndarray], left: int) -> tuple[np.ndarray, int]:
    """Copies of each length that come closest to ``left`` words from below, and the words still open.

    The programme over reachable sums is a row of bits, shifted once per power of two of a length's copies. Copies of the
    first of ``limits`` are used before those of the second, and nothing is added once the sum is met.
    """
    more = np.zeros(len(sizes), np.int64)
    if left <= 0:
        return more, 0
    # reach: bit b is set if some choice of the items so far sums to b; by[b]: the item that first reached b
    reach, mask, by, items = 1, (1 << (left + 1)) - 1, np.full(left + 1, -1, np.int32), []
    for limit in limits:
        for i in order:
            room, copies = min(int(limit[i]), left // int(sizes[i])), 1
            while room > 0 and not reach >> left & 1:
                n = min(copies, room)
                new = (reach << n * int(sizes[i])) & mask & ~reach
                if new:
                    bits = np.unpackbits(np.frombuffer(new.to_bytes(left // 8 + 1, "little"), np.uint8), bitorder="little")
                    by[np.flatnonzero(bits)] = len(items)
                    items.append((i, n))
                    reach |= new
                room, copies = room - n, copies * 2
    at = reach.bit_length() - 1
    open_words = left - at
    while at > 0:
        i, n = items[by[at]]
        more[i] += n
        at -= n * int(sizes[i])
    return more, open_words


def mix_sources(
    docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), most_copies: int = 3, key: str = "doc_id", text: str = "text",
    source: str = "source", seed: int = 17, spare: int = 1 << 16, buckets: int = 256,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, times.

    ``size`` is the number of words of the whole text, ``times`` how often the mix takes the document (0 to
    ``most_copies``), ``taken`` the words that makes. Sources in code point order, null last as a source of its own,
    take ``weights`` in turn. ``spare`` bounds the words left to the dynamic programme of one source, beyond the length
    of one document; its input is the number of documents of each length, never documents.

    Null and empty texts have size 0 and are never taken. Repeated rows are documents of their own; rows with the same
    id are equal to the seeded choice, so which of them is taken shows only in their number. Other columns are left out;
    an empty table gives no rows.
    """
    spread = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(buckets)).cast("int")
    sized = settled(docs.select(
        F.col(key).alias("doc_id"), F.struct(F.col(source).alias("source")).alias("_source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), spread.alias("_bucket")))
    cells = settled(sized.groupBy("_source", "size", "_bucket").count())
    lengths = cells.groupBy("_source", "size").agg(F.sum("count").alias("count"))
    totals = lengths.groupBy("_source").agg(F.sum(F.col("size") * F.col("count")).alias("source_size"))
    targets = settled(source_targets(totals, weights, most_copies))

    def fit(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(parts).sort_values("size")
        sizes, counts = rows["size"].to_numpy(np.int64), rows["count"].to_numpy(np.int64)
        some = sizes > 0
        copies = np.zeros(len(rows), np.int64)
        copies[some] = fitted_copies(sizes[some], counts[some], float(rows["target"].iloc[0]), most_copies, spare)
        out = rows[["_source", "size", "source_size", "target"]].copy()
        out["_each"], out["_more"] = copies // counts, copies % counts
        yield out

    # a group is the lengths that occur in one source, however many documents it has
    plan = settled(lengths.join(targets, "_source").groupBy("_source").applyInPandas(
        fit, "_source struct<source:string>, size long, source_size long, target double, _each long, _more long"))
    # The first _more documents of a length in seeded order get one copy more: whole buckets, and a part of one.
    choice = cells.join(plan, ["_source", "size"]).selectExpr(
        "_source", "size", "_bucket", "count", "source_size", "target", "_each", "_more",
        "coalesce(sum(count) over (partition by _source, size order by _bucket"
        " rows between unbounded preceding and 1 preceding), 0) as _before",
    ).selectExpr("_source", "size", "_bucket", "source_size", "target", "_each", "least(count, greatest(0, _more - _before)) as _extra")
    place = f"row_number() over (partition by _source, size, _bucket order by xxhash64({seed + 1}L, doc_id), doc_id)"
    return sized.join(choice, ["_source", "size", "_bucket"]).selectExpr(
        "doc_id", "size", "source_size", "target", f"_each + if({place} <= _extra, 1, 0) as times",
    ).selectExpr("doc_id", "size", "source_size", "target", "size * times as taken", "times")
