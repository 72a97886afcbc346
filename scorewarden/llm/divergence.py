"""Divergence of sources: term distributions counted in a second pass through sharded minimal perfect hashes.

The first pass counts, exactly, in how many documents of its language each term occurs; frequent terms are kept. Each shard of
a language's kept terms gets a minimal perfect hash (buckets of keys, each with a displacement seed that sends its keys to
free slots) beside the terms in slot order, which a look-up compares with: a term that was not kept hits some slot and is
told apart there. The shards are broadcast, in rounds of a stated number of bytes; the second pass adds to dense slots per
group, which are emptied into counted cells whenever they reach a stated size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewarden.llm.common import mixed_bits, settled
from scorewarden.llm.terms import term_bytes, term_counts
from scorewarden.storage import small_side

_TABLE = term_bytes(digits=False)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: A slot's number: its shard in the high bits.
_SLOT_BITS = 24
_SHARE = 1_000_000_000


def key_hashes(terms) -> np.ndarray:
    """Two independent 64-bit hashes of each term, one row each."""
    import xxhash
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(t) for t in terms.to_pylist()), np.uint64).reshape(-1, 2)


def displaced(h: np.ndarray, seeds: np.ndarray, size) -> np.ndarray:
    return (mixed_bits(h + seeds * _STEP) % size).astype(np.int64)


def perfect_hash(h: np.ndarray, per_bucket: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(seed of each bucket, slot of each key): a bijection of n distinct keys onto 0 to n - 1.

    Buckets are placed from the largest down; a bucket takes the first seed that sends all its keys to free slots.
    """
    n = len(h)
    buckets = max(1, -(-n // per_bucket))
    own = (mixed_bits(h[:, 0]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(own, kind="stable")
    sizes = np.bincount(own, minlength=buckets)
    ends = np.cumsum(sizes)
    seeds, slots, taken = np.zeros(buckets, np.uint64), np.zeros(n, np.int64), np.zeros(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        if not sizes[b]:
            break
        keys = order[ends[b] - sizes[b]: ends[b]]
        at, width = 0, 32
        while True:
            tried = np.arange(at, at + width, dtype=np.uint64)
            spots = displaced(h[keys, 1][None, :], tried[:, None], np.uint64(n))
            good = ~taken[spots].any(1)
            if len(keys) > 1:
                ranked = np.sort(spots, 1)
                good &= (ranked[:, 1:] != ranked[:, :-1]).all(1)
            if good.any():
                i = int(good.argmax())
                seeds[b], slots[keys] = tried[i], spots[i]
                taken[spots[i]] = True
                break
            at, width = at + width, min(width * 4, 1 << 14)
    return seeds, slots


class Shards:
    """Broadcast shards: one flat array per part of their hashes, and the stored terms in slot order."""

    def __init__(self, rows):
        """``rows``: (lang, shards of the language, shard, seeds as bytes, terms)."""
        import pyarrow as pa
        self.count = {r[0]: r[1] for r in rows}
        self.index = {lang: np.full(n, -1, np.int64) for lang, n in self.count.items()}
        seeds, terms = [], []
        for i, (lang, _, shard, packed, names) in enumerate(rows):
            self.index[lang][shard] = i
            seeds.append(np.frombuffer(packed, np.uint64))
            terms.append(names)
        self.shard = np.array([r[2] for r in rows], np.int64)
        self.buckets, self.sizes = np.array([len(s) for s in seeds], np.uint64), np.array([len(t) for t in terms], np.uint64)
        self.seed_at = np.concatenate([[0], np.cumsum(self.buckets.astype(np.int64))])
        self.term_at = np.concatenate([[0], np.cumsum(self.sizes.astype(np.int64))])
        self.seeds = np.concatenate(seeds)
        self.terms = pa.array([t.encode() if isinstance(t, str) else t for names in terms for t in names], pa.large_binary())

    def slots(self, lang, h: np.ndarray, code: np.ndarray, terms) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``code`` are stored terms of ``lang``, the number of the slot of each that is)."""
        import pyarrow as pa
        import pyarrow.compute as pc
        if lang not in self.index:
            return np.zeros(len(code), bool), np.zeros(0, np.int64)
        keys = h[code]
        own = self.index[lang][(keys[:, 0] % np.uint64(self.count[lang])).astype(np.int64)]
        here = np.flatnonzero(own >= 0)
        own, keys = own[here], keys[here]
        bucket = (mixed_bits(keys[:, 0]) % self.buckets[own]).astype(np.int64)
        slot = displaced(keys[:, 1], self.seeds[self.seed_at[own] + bucket], self.sizes[own])
        same = pc.equal(self.terms.take(pa.array(self.term_at[own] + slot)), terms.take(pa.array(code[here]))).to_numpy(zero_copy_only=False)
        found = np.zeros(len(code), bool)
        found[here[same]] = True
        return found, (self.shard[own[same]] << _SLOT_BITS) | slot[same]


def document_frequencies(docs: DataFrame, most_rows: int = 1 << 18) -> DataFrame:
    """(_lang, _term, _docs) of (_lang, _text): in how many documents each term occurs, exactly; added up in the task first."""
    import pyarrow as pa

    def summed(held):
        table = pa.concat_tables(held).group_by(["_lang", "_term"]).aggregate([("_docs", "sum")])
        return pa.table({"_lang": table["_lang"], "_term": table["_term"].cast(pa.string()), "_docs": table["_docs_sum"]}).combine_chunks().to_batches()

    def run(batches):
        held, n = [], 0
        for batch in batches:
            lang = batch.column(0).dictionary_encode()
            number, names = lang.indices.to_numpy().astype(np.int64), lang.dictionary
            for row, code, _, terms in term_counts(batch.column(1), _TABLE):
                cells, docs = np.unique(number[row] * max(1, len(terms)) + code, return_counts=True)
                which, code = np.divmod(cells, max(1, len(terms)))
                held.append(pa.table({"_lang": names.take(pa.array(which)), "_term": terms.take(pa.array(code)), "_docs": docs}))
                n += len(cells)
                if n > most_rows:
                    yield from summed(held)
                    held, n = [], 0
        if held:
            yield from summed(held)

    return docs.select("_lang", "_text").mapInArrow(run, "_lang string, _term string, _docs long").groupBy("_lang", "_term").agg(F.sum("_docs").alias("_docs"))


def perfect_shards(kept: DataFrame, shard_terms: int = 4096) -> DataFrame:
    """(_lang, _shards, _shard, _seeds, _terms): a minimal perfect hash for about ``shard_terms`` of the kept (_lang, _term) each."""
    import pyarrow as pa
    sizes = kept.groupBy("_lang").agg(F.ceil(F.count("*") / shard_terms).cast("long").alias("_shards"))

    def dealt(batches):
        for batch in batches:
            shard = (key_hashes(batch.column(1).cast(pa.binary()))[:, 0] % batch.column(2).to_numpy().astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], names=["_lang", "_term", "_shards", "_shard"])

    def made(table):
        seeds, slots = perfect_hash(key_hashes(table["_term"].cast(pa.binary())))
        order = np.empty(len(slots), np.int64)
        order[slots] = np.arange(len(slots))
        return pa.table({
            "_lang": table["_lang"][:1], "_shards": table["_shards"][:1], "_shard": table["_shard"][:1],
            "_seeds": pa.array([seeds.tobytes()], pa.binary()), "_terms": pa.array([table["_term"].take(pa.array(order)).to_pylist()], pa.list_(pa.string()))})

    rows = kept.join(small_side(sizes), "_lang").select("_lang", "_term", "_shards").mapInArrow(dealt, "_lang string, _term string, _shards long, _shard long")
    return rows.groupBy("_lang", "_shard").applyInArrow(made, "_lang string, _shards long, _shard long, _seeds binary, _terms array<string>")


def recount(docs: DataFrame, shards: DataFrame, *, round_bytes: int = 32 << 20, most_slots: int = 1 << 23) -> DataFrame:
    """(_lang, _source, _at, _n): occurrences of each stored term in each group of (_lang, _source, _text); cells that are 0 are left out.

    Shards are broadcast in rounds of about ``round_bytes``; the texts are read once a round. A task holds dense slots for the
    groups it meets, at most about ``most_slots`` numbers of 4 bytes before they are emptied.
    """
    import pyarrow as pa
    weight = F.length("_seeds") + F.aggregate("_terms", F.lit(0), lambda a, t: a + F.octet_length(t) + 16)
    rounds = max(1, -(-int(shards.agg(F.sum(weight.cast("long"))).first()[0] or 0) // round_bytes))
    spark, cells = docs.sparkSession, None
    for i in range(rounds):
        chosen = shards.where(F.pmod(F.xxhash64("_lang", "_shard"), F.lit(rounds)) == i)
        rows = [tuple(r) for r in chosen.select("_lang", "_shards", "_shard", "_seeds", "_terms").collect()]  # about round_bytes
        if not rows:
            continue
        sent = spark.sparkContext.broadcast(rows)
        sizes: dict = {}
        for r in rows:
            sizes.setdefault(r[0], {})[r[2]] = len(r[4])

        def run(batches, sent=sent, sizes=sizes):
            table = Shards(sent.value)
            starts, ends = {}, {}
            for lang, of in sizes.items():
                starts[lang], at = np.zeros(max(of) + 1, np.int64), 0
                for shard, n in sorted(of.items()):
                    starts[lang][shard], at = at, at + n
                ends[lang] = at
            numbers = {lang: np.concatenate([(s << _SLOT_BITS) | np.arange(n) for s, n in sorted(of.items())]) for lang, of in sizes.items()}
            dense: dict = {}
            added = 0  # since the slots were emptied; below what a slot can hold

            def emptied():
                keys = sorted(dense)
                at = [np.flatnonzero(dense[k]) for k in keys]
                yield pa.RecordBatch.from_arrays([
                    pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                    pa.array([numbers[k[0]][a] for k, a in zip(keys, at, strict=True)], pa.list_(pa.int64())),
                    pa.array([dense[k][a].astype(np.int64) for k, a in zip(keys, at, strict=True)], pa.list_(pa.int64()))], names=["_lang", "_source", "_at", "_n"])
                dense.clear()

            for batch in batches:
                pairs = pa.table({"l": batch.column(0), "s": batch.column(1)})
                lang, source = pairs["l"].combine_chunks().dictionary_encode(), pairs["s"].combine_chunks().dictionary_encode()
                both = lang.indices.to_numpy().astype(np.int64) * max(1, len(source.dictionary)) + source.indices.to_numpy()
                known, group = np.unique(both, return_inverse=True)
                langs, sources = lang.dictionary.to_pylist(), source.dictionary.to_pylist()
                names = [(langs[k // len(sources)], sources[k % len(sources)]) for k in known]
                for row, code, count, terms in term_counts(batch.column(2), _TABLE):
                    if not len(row):
                        continue
                    keys, inverse = np.unique(group[row] * len(terms) + code, return_inverse=True)
                    n = np.bincount(inverse, count).astype(np.int64)
                    if dense and added + n.sum() >= 1 << 31:
                        yield from emptied()
                        added = 0
                    added += int(n.sum())
                    h = key_hashes(terms)
                    of, code = np.divmod(keys, len(terms))
                    edges = np.flatnonzero(np.r_[True, np.diff(of) > 0, True])
                    for a, b in zip(edges[:-1], edges[1:], strict=True):
                        name = names[of[a]]
                        found, at = table.slots(name[0], h, code[a:b], terms)
                        if not found.any():
                            continue
                        if name not in dense:
                            if dense and sum(map(len, dense.values())) + ends[name[0]] > most_slots:
                                yield from emptied()
                            # a single long text may hold more than a small slot
                            dense[name] = np.zeros(ends[name[0]], np.int32 if added < 1 << 31 else np.int64)
                        dense[name][starts[name[0]][at >> _SLOT_BITS] + (at & ((1 << _SLOT_BITS) - 1))] += n[a:b][found].astype(dense[name].dtype)
            if dense:
                yield from emptied()

        part = docs.select("_lang", "_source", "_text").mapInArrow(run, "_lang string, _source string, _at array<long>, _n array<long>")
        part = part.select("_lang", "_source", F.explode(F.arrays_zip("_at", "_n")).alias("_c")).select("_lang", "_source", "_c._at", "_c._n")
        part = part.groupBy("_lang", "_source", "_at").agg(F.sum("_n").alias("_n"))
        cells = part if cells is None else cells.unionByName(part)
    return settled(cells if cells is not None else spark.createDataFrame([], "_lang string, _source string, _at long, _n long"))


def source_divergence(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 30, top: int = 50, tile: int = 256,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language stands from the others, and by which terms.

    Terms are runs of letters and of everything outside ASCII, A-Z lower-cased; a language keeps those in at least
    ``least_docs`` of its documents. With N a group's occurrences of the V kept terms, a term has p = 1 + floor(10^9 (count + 5)
    / (N + 5 V)). Part ``pair``: the sum of the differences of p over all kept terms, for each other source, all ranks. Part
    ``term``: terms of the group with a higher p than in the whole language, by that difference, ``top`` ranks. Ties in UTF-8
    order. Null texts, languages and sources count as empty; each row is a document, repeated rows too; a group without
    terms has its row in each pair. An empty table gives no rows. Other columns are ignored.
    """
    import pyarrow as pa
    rows = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "_lang"), (source, "_source"), (text, "_text"))))
    groups = settled(rows.select("_lang", "_source").distinct())
    kept = settled(document_frequencies(rows).where(F.col("_docs") >= least_docs).select("_lang", "_term"))
    shards = settled(perfect_shards(kept))
    cells = recount(rows, shards)
    sizes = shards.select("_lang", "_shard", F.size("_terms").alias("_size"))
    terms_of = small_side(shards.groupBy("_lang").agg(F.sum(F.size("_terms")).alias("_v")))
    totals = cells.groupBy("_lang", "_source").agg(F.sum("_n").alias("_total"))

    def p(n, total):
        top_, below = f"cast({_SHARE} as decimal(10,0)) * cast({n} + 5 as decimal(18,0))", f"cast(greatest({total} + 5 * _v, 1) as decimal(20,0))"
        return F.expr(f"1 + ({top_}) div ({below})")

    known = (
        groups.join(totals, ["_lang", "_source"], "left").join(terms_of, "_lang", "left").na.fill(0, ["_total", "_v"])
        .withColumn("_tiles", F.ceil(F.count("*").over(Window.partitionBy("_lang")) / tile).cast("int"))
        .withColumn("_tile", F.pmod(F.xxhash64("_source"), F.col("_tiles")).cast("int")).withColumn("_base", p("0L", "_total")))
    known = settled(known)
    valued = cells.join(known.select("_lang", "_source", "_total", "_v"), ["_lang", "_source"]).withColumn("_p", p("_n", "_total"))

    # part pair: blocks of slots by two tiles of sources
    shard = F.shiftright("_at", _SLOT_BITS).alias("_shard")
    packed = valued.groupBy("_lang", "_source", shard).agg(
        F.collect_list(F.struct((F.col("_at").bitwiseAND((1 << _SLOT_BITS) - 1)).alias("s"), F.col("_p").alias("p"))).alias("_cells"))
    frame = known.join(sizes, "_lang", "left").na.fill(0, ["_shard", "_size"]).join(packed, ["_lang", "_source", "_shard"], "left")
    dealt = frame.select(
        "_lang", "_source", "_shard", "_size", "_tile", "_base", F.col("_cells.s").alias("_s"), F.col("_cells.p").alias("_p"),
        F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)).alias("_other"))
    dealt = dealt.withColumns({"_a": F.least("_tile", "_other"), "_b": F.greatest("_tile", "_other")})

    def apart(table):
        n = int(table["_size"][0].as_py())
        sources, tile_of = table["_source"].to_pylist(), table["_tile"].to_numpy()
        values = np.repeat(table["_base"].to_numpy()[:, None], n, 1)
        for i, (s, v) in enumerate(zip(table["_s"], table["_p"], strict=True)):
            if s.is_valid:
                values[i, s.values.to_numpy()] = v.values.to_numpy()
        a, b = int(table["_a"][0].as_py()), int(table["_b"][0].as_py())
        left, right = np.flatnonzero(tile_of == a), np.flatnonzero(tile_of == b)
        out: list = [[], [], []]
        for i in left:
            others = right[right > i] if a == b else right
            f = np.abs(values[others] - values[i]).sum(1)
            for one, two in ((np.full(len(others), i), others), (others, np.full(len(others), i))):
                out[0].append(one)
                out[1].append(two)
                out[2].append(f)
        one, two, f = (np.concatenate([np.zeros(0, np.int64), *x]) for x in out)
        names = pa.array(sources, pa.string())
        return pa.table({"_lang": pa.array([table["_lang"][0].as_py()] * len(f), pa.string()), "_source": names.take(pa.array(one)), "item": names.take(pa.array(two)), "value": f})

    pairs = dealt.groupBy("_lang", "_shard", "_a", "_b").applyInArrow(apart, "_lang string, _source string, item string, value long")
    pairs = pairs.groupBy("_lang", "_source", "item").agg(F.sum("value").alias("value"))
    by_value = Window.partitionBy("_lang", "_source").orderBy(F.desc("value"), "item")

    # part term
    whole = cells.groupBy("_lang", "_at").agg(F.sum("_n").alias("_n"))
    language = small_side(cells.groupBy("_lang").agg(F.sum("_n").alias("_total")).join(terms_of, "_lang"))
    names = shards.select("_lang", "_shard", F.posexplode("_terms").alias("_slot", "item")).select(
        "_lang", (F.shiftleft("_shard", _SLOT_BITS) + F.col("_slot")).alias("_at"), "item")
    expected = whole.join(language, "_lang").withColumn("_q", p("_n", "_total")).select("_lang", "_at", "_q").join(names, ["_lang", "_at"])
    above = valued.select("_lang", "_source", "_at", "_p").join(expected, ["_lang", "_at"]).where("_p > _q")
    above = above.select("_lang", "_source", "item", (F.col("_p") - F.col("_q")).alias("value")).withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    both = pairs.withColumns({"rank": F.row_number().over(by_value), "part": F.lit("pair")}).unionByName(above.withColumn("part", F.lit("term")))
    return both.select(F.col("_lang").alias("lang"), F.col("_source").alias("source"), "part", "item", "value", F.col("rank").cast("int").alias("rank"))
