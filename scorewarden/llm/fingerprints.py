"""Fingerprints from which the differing paragraphs of two versions can be read back.

A fingerprint is an invertible Bloom lookup sketch: every paragraph digest is
added to one cell of each of three tables, and a cell keeps a count, the xor of
its digests and the xor of their check values. Subtracting two sketches leaves
the digests that only one version has. Cells with a single digest are read and
removed until nothing is left; where that fails, larger sketches are tried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewarden.llm.common import settled, text_key
from scorewarden.operators.ordering import add_bucket, bucket_edges

#: Cells per table of the printed fingerprint, and of the first retry.
FIRST, SECOND = 8, 32
_TABLES, _FIELD, _CHECK = 3, 21, 0xFFFFFFFF


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed a single time."""
    return F.element_at(F.transform(F.array(value), use), 1)


def paragraph_digests(text: Column) -> Column:
    """Distinct 64-bit digests of the lines that are not empty; a null text has none."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda p: p != "")
    return F.array_distinct(F.transform(lines, lambda p: F.xxhash64(p)))


def check_value(digest: Column) -> Column:
    return F.xxhash64(digest).bitwiseAND(_CHECK)


def cell_of(digest: Column, table: Column | int, width: Column | int) -> Column:
    """The cell of a table: a field of 21 bits of the digest, cut to the width, a power of two."""
    shift = F.lit(table) * _FIELD if isinstance(table, int) else table * _FIELD
    wide = width if isinstance(width, Column) else F.lit(width)
    return F.call_function("shiftrightunsigned", digest, shift.cast("int")).bitwiseAND((wide - 1).cast("long"))


def sketch(digests: Column, width: int) -> Column:
    """Array of the cells (n, key, check) of three tables of ``width`` cells."""
    def cell(at: Column) -> Column:
        table, place = F.floor(at / width).cast("int"), at % width
        inside = F.filter(digests, lambda d: cell_of(d, table, width) == place)
        empty = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("check"))
        return F.aggregate(inside, empty, lambda c, d: F.struct(
            (c["n"] + 1).alias("n"), c["key"].bitwiseXOR(d).alias("key"), c["check"].bitwiseXOR(check_value(d)).alias("check")))
    return F.transform(F.sequence(F.lit(0), F.lit(_TABLES * width - 1)), cell)


def difference(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct(
        (x["n"] - y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"), x["check"].bitwiseXOR(y["check"]).alias("check")))


def peeled(cells: Column, width: int, rounds: int = 12) -> Column:
    """The number of digests that only one version has, or null if the sketch is too small to read them all."""
    def alone(c: Column) -> Column:
        return (F.abs(c["n"]) == 1) & (check_value(c["key"]) == c["check"])

    def without(cells: Column, pure: Column) -> Column:
        def less(c: Column, at: Column) -> Column:
            table, place = F.floor(at / width).cast("int"), at % width
            return F.aggregate(F.filter(pure, lambda p: cell_of(p["key"], table, width) == place), c, lambda s, p: F.struct(
                (s["n"] - p["n"]).alias("n"), s["key"].bitwiseXOR(p["key"]).alias("key"), s["check"].bitwiseXOR(p["check"]).alias("check")))
        return F.transform(cells, less)

    def step(state: Column, _: Column) -> Column:
        pure = F.array_distinct(F.filter(state["cells"], alone))
        return once(pure, lambda p: F.when(F.size(p) == 0, state).otherwise(
            F.struct(without(state["cells"], p).alias("cells"), (state["found"] + F.size(p)).alias("found"))))

    start = F.struct(cells.alias("cells"), F.lit(0).alias("found"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)
    empty = lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0)
    return once(end, lambda s: F.when(F.forall(s["cells"], empty), s["found"]))


def printed(cells: Column) -> Column:
    """Cells as text: count, key and check in hexadecimal, an empty cell as a dash."""
    return F.array_join(F.transform(cells, lambda c: F.when(c["n"] == 0, "-").otherwise(
        F.concat_ws(".", c["n"].cast("string"), F.lower(F.hex(c["key"])), F.lower(F.hex(c["check"]))))), " ")


def likeness(a: Column, b: Column, differing: Column) -> Column:
    """Jaccard similarity of two paragraph sets from their sizes and their difference; 1 for two empty ones."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 1.0).otherwise((both - differing) / (both + differing))


def large_differences(pairs: DataFrame) -> DataFrame:
    """(_id, _side, _differing) of pairs (_id, _side, _a, _b) of digest arrays whose small sketches failed.

    Cells are rows here, so that a version of any length is spread over tasks. Widths follow the number of digests, and
    pairs that still fail come back with tables four times as wide. Pairs that fail at the widest table are compared digest
    by digest.
    """
    done, factor = None, 1
    open_pairs = settled(pairs)
    while not open_pairs.isEmpty():
        need = (F.size("_a") + F.size("_b")) * factor
        width = F.least(F.lit(1 << _FIELD), F.pow(F.lit(2.0), F.ceil(F.log2(need.cast("double")))).cast("long"))
        both = open_pairs.withColumn("_width", width)
        signed = both.select("_id", "_side", "_width", F.explode("_a").alias("key"), F.lit(1).alias("n")).unionByName(
            both.select("_id", "_side", "_width", F.explode("_b").alias("key"), F.lit(-1).alias("n")))

        def spread(rows: DataFrame) -> DataFrame:
            places = F.array(*(F.lit(t) * (1 << _FIELD) + cell_of(F.col("key"), t, F.col("_width")) for t in range(_TABLES)))
            return rows.select("_id", "_side", "_width", F.explode(places).alias("_cell"), "n", "key", check_value(F.col("key")).alias("check"))

        def summed(rows: DataFrame) -> DataFrame:
            cells = rows.groupBy("_id", "_side", "_width", "_cell").agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check"))
            return settled(cells.where("n != 0 or key != 0 or check != 0"))

        cells, found = summed(spread(signed)), None
        while True:
            pure = settled(cells.where((F.abs("n") == 1) & (check_value(F.col("key")) == F.col("check"))).select(
                "_id", "_side", "_width", "key", "n").dropDuplicates(["_id", "_side", "key"]))
            if pure.isEmpty():
                break
            counted = pure.groupBy("_id", "_side").agg(F.count("*").alias("_n"))
            found = counted if found is None else found.unionByName(counted)
            cells = summed(cells.unionByName(spread(pure.withColumn("n", -F.col("n")))))
        left = cells.select("_id", "_side").distinct()
        read = open_pairs.select("_id", "_side").join(left, ["_id", "_side"], "left_anti")
        read = read.withColumn("_differing", F.lit(0).cast("long")) if found is None else read.join(
            found.groupBy("_id", "_side").agg(F.sum("_n").alias("_differing")), ["_id", "_side"], "left").fillna(0, ["_differing"])
        done = read if done is None else done.unionByName(read)
        failed = settled(both.select("_id", "_side", "_width").join(left, ["_id", "_side"], "left_semi"))
        widest = failed.where(F.col("_width") == 1 << _FIELD).select("_id", "_side")
        if not widest.isEmpty():
            exact = signed.join(widest, ["_id", "_side"], "left_semi").groupBy("_id", "_side", "key").agg(F.sum("n").alias("n")).where("n != 0")
            done = done.unionByName(widest.join(
                exact.groupBy("_id", "_side").agg(F.count("*").alias("_differing")), ["_id", "_side"], "left").fillna(0, ["_differing"]))
        again = failed.where(F.col("_width") < 1 << _FIELD).select("_id", "_side")
        open_pairs, factor = settled(open_pairs.join(again, ["_id", "_side"], "left_semi")), factor * 4
    return done if done is not None else pairs.select("_id", "_side", F.lit(0).cast("long").alias("_differing")).limit(0)


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(_key, _text, _next): each document and the text of the one after it in descending key order, the last and the first too.

    Keys are cut into ranges, null keys last by their text. Each range gets a copy of the first document of the range
    after it, so that every text moves once and no task sees more than a range.
    """
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
    rows = rows.withColumns(dict(zip(["_k1", "_k2"], text_key(F.col("_text")), strict=True))).withColumn("_spot", F.col("_key").cast("double"))
    edges = bucket_edges(rows, "_spot")
    rows = add_bucket(rows, "_spot", edges, "_bucket").withColumns({
        "_range": -F.coalesce(F.when(F.col("_key").isNull(), -1).otherwise(F.col("_bucket")), F.lit(-1)),
        "_part": F.when(F.col("_key").isNull(), F.shiftright("_k1", 58)).otherwise(0)}).select("_key", "_text", "_k1", "_k2", "_range", "_part")
    order = F.struct(F.coalesce(-(F.col("_key").cast("decimal(20,0)")), F.lit(0).cast("decimal(20,0)")).alias("o"), "_k1", "_k2")
    heads = rows.groupBy("_range", "_part").agg(F.min(order).alias("_head"))
    # one row per range
    chained = heads.selectExpr(
        "_head", "coalesce(lag(_range) over (order by _range, _part), last(_range) over (order by _range, _part rows between unbounded preceding and unbounded following)) as _to_range",
        "coalesce(lag(_part) over (order by _range, _part), last(_part) over (order by _range, _part rows between unbounded preceding and unbounded following)) as _to_part",
        "_range", "_part")
    guards = rows.withColumn("_head", order).join(F.broadcast(chained), ["_range", "_part", "_head"]).select(
        "_key", "_text", "_k1", "_k2", F.col("_to_range").alias("_range"), F.col("_to_part").alias("_part"), F.lit(1).alias("_guard"))
    return rows.withColumn("_guard", F.lit(0)).unionByName(guards).withColumn("_next", F.expr(
        "lead(_text) over (partition by _range, _part order by _guard, _key desc, _k1, _k2)")).where("_guard = 0").select("_key", "_text", "_next")


def version_fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text ends in the beginning of the next document instead of its own last third. Paragraphs are the distinct
    lines that are not empty, so texts with the same lines share a fingerprint, and texts without any have an empty one;
    two of those are alike (1.0). A null text counts as empty. Documents follow each other in descending key order, null
    keys last; equal keys, and null ones, go by a hash of their text. Repeated rows are documents of their own. Other
    columns are left out; an empty table gives no rows.
    """
    size = F.char_length("_text")
    third = F.floor(size / 3).cast("int")
    edited = F.concat(F.expr("left(_text, char_length(_text) - cast(floor(char_length(_text) / 3) as int))"), F.expr("left(_next, cast(floor(char_length(_text) / 3) as int))"))
    rows = with_next(docs, key, text).withColumn("_edited", F.when(third == 0, F.col("_text")).otherwise(edited))
    rows = settled(rows.select(
        "_key", size.cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"),
        paragraph_digests(F.col("_text")).alias("_a"), paragraph_digests(F.col("_edited")).alias("_e"), paragraph_digests(F.col("_next")).alias("_n"),
    ).withColumn("_id", F.monotonically_increasing_id()))

    def differing(a: str, b: str) -> Column:
        # the first sketch can't hold more than its cells; skip the attempt where it is hopeless by size alone
        levels = [F.when(F.abs(F.size(a) - F.size(b)) <= 3 * w, once(sketch(F.col(a), w), lambda x: once(
            sketch(F.col(b), w), lambda y: peeled(difference(x, y), w)))) for w in (FIRST, SECOND)]
        levels[1] = F.when(F.size(a) + F.size(b) <= 6 * SECOND, levels[1])
        return F.coalesce(*levels)

    tried = settled(rows.withColumns({"_edit_n": differing("_a", "_e"), "_next_n": differing("_a", "_n")}))
    failed = tried.where("_edit_n is null").select("_id", F.lit(0).alias("_side"), "_a", F.col("_e").alias("_b")).unionByName(
        tried.where("_next_n is null").select("_id", F.lit(1).alias("_side"), "_a", F.col("_n").alias("_b")))
    late = large_differences(failed).groupBy("_id").agg(*(
        F.max(F.when(F.col("_side") == i, F.col("_differing"))).alias(n) for i, n in enumerate(("_late_edit", "_late_next"))))
    return tried.join(late, "_id", "left").select(
        F.col("_key").alias(key), "n_chars", "edited_sha256", printed(sketch(F.col("_a"), FIRST)).alias("fingerprint"),
        printed(sketch(F.col("_e"), FIRST)).alias("edited_fingerprint"),
        likeness(F.col("_a"), F.col("_e"), F.coalesce("_edit_n", "_late_edit")).alias("near_edited"),
        likeness(F.col("_a"), F.col("_n"), F.coalesce("_next_n", "_late_next")).alias("near_next"))
