"""Find benchmark items in documents by their templates, and re-parameterised ones by consistent slots.

Numbers, names and units become typed placeholders. Windows of template tokens
are hashed and joined with the windows of all items. Where they meet, the values
in the slots are compared: an item whose values were exchanged is still the same
item if every value was exchanged for the same other value throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewarden.llm.common import SPACE, settled, text_key
from scorewarden.storage import small_side

#: Marks that are no part of a word's value, as trim characters.
MARKS = ".,;:!?*&%$#\"'()[]{}<>|/\\-_=+~`^"
UNITS = (
    "mm", "cm", "m", "km", "mg", "g", "kg", "ml", "l", "s", "sec", "min", "h", "hours", "minutes", "seconds", "days", "weeks", "years",
    "percent", "dollars", "euros", "usd", "eur", "miles", "feet", "inches", "pounds", "kmh", "mph",
)
ENDS = (".", "!", "?", ":")
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"


def _parted(df: DataFrame, text: Column) -> DataFrame:
    """Add _words, the words of a text between white space, and _values, the same in lower case without marks around them."""
    cut = f"[{SPACE}]+"
    return df.select("*", F.split(text, cut, -1).alias("_words"), F.transform(
        F.split(F.lower(text), cut, -1), lambda w: F.btrim(w, F.lit(MARKS))).alias("_values"))


def template_hash(value: Column, i: Column) -> Column:
    """Hash of the template word at place i of _words: of its placeholder, or of its value; null for a word of marks only.

    A name is a word with one capital, its first letter, that neither begins the text nor follows the end of a sentence.
    """
    word, before = F.get("_words", i), F.get("_words", i - 1)
    rest = F.substring(word, 2, 1 << 30)
    # most words have no capital and are done after a comparison
    name = (F.lower(word) != word) & (rest == F.lower(rest)) & (i > 0) & (before != "") & ~F.substring(before, -1, 1).isin(*ENDS)
    return (
        F.when(value == "", None).when((value >= "0") & (value < ":"), F.xxhash64(F.lit(NUMBER)))
        .when(value.isin(*UNITS), F.xxhash64(F.lit(UNIT))).when(name, F.xxhash64(F.lit(NAME))).otherwise(F.xxhash64(value)))


def _tokens(df: DataFrame, text: Column) -> DataFrame:
    """Replace the text's words by _hashes, the hashes of its template words, and _values, what they stand for."""
    hashed = _parted(df, text).withColumn("_hashes", F.array_compact(F.transform("_values", template_hash)))
    return hashed.withColumn("_values", F.filter("_values", lambda v: v != "")).drop("_words")


def _window_hash(i: Column, width: int | Column, exact: bool) -> Column:
    """Hash of the template, or with ``exact`` of the values, of the window at place i."""
    return F.xxhash64(F.lit("exact"), F.slice("_values", i, width)) if exact else F.xxhash64(F.slice("_hashes", i, width))


def _every_window(kinds: list[tuple[int, bool]], make) -> Column:
    """``make`` of the place, the width and the hash of every window of every kind (width, exact) of a text."""
    def of(width: int, exact: bool) -> Column:
        size = F.size("_hashes")
        return F.when(size >= width, F.transform(
            F.sequence(F.lit(1), size - (width - 1)), lambda i: make(i, width, _window_hash(i, width, exact)))).otherwise(F.array())

    return F.concat(*(of(*kind) for kind in kinds))


def item_windows(items: DataFrame, key: str, text: str, width: int, least_words: int) -> DataFrame:
    """Every window of every item: _hash, item_id, _at, _width, _exact, _slots, and the item's numbers of windows _of and of template windows _free.

    Windows with fewer than ``least_words`` words outside slots say too little as templates: they are _exact, hashed with
    their values. An item of fewer than ``width`` words is one such window of its own length.
    """
    named = items.select(F.col(key).alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")).where(F.col("item_id").isNotNull())
    tokens = _tokens(named, F.col("_text")).where(F.size("_hashes") > 0).withColumn("_width", F.least(F.size("_hashes"), F.lit(width)))
    rows = tokens.select("*", F.explode(F.sequence(F.lit(1), F.size("_hashes") - F.col("_width") + 1)).alias("_at"))
    names = [F.xxhash64(F.lit(p)) for p in (NUMBER, NAME, UNIT)]
    part = F.zip_with(
        F.slice("_hashes", F.col("_at"), F.col("_width")), F.slice("_values", F.col("_at"), F.col("_width")),
        lambda h, v: F.struct(((h == names[0]) | (h == names[1]) | (h == names[2])).alias("slot"), v.alias("value")))
    slots = F.filter(F.transform(part, lambda t, i: F.struct(i.alias("i"), t["slot"].alias("slot"), t["value"].alias("value"))), lambda s: s["slot"])
    found = rows.withColumn("_slots", slots).withColumn("_exact", (F.col("_width") < width) | (F.lit(width) - F.size("_slots") < least_words))
    hashes = F.when(F.col("_exact"), _window_hash(F.col("_at"), F.col("_width"), True)).otherwise(_window_hash(F.col("_at"), F.col("_width"), False))
    found = found.select("item_id", "_at", "_width", "_exact", "_slots", hashes.alias("_hash")).dropDuplicates(["item_id", "_at"])
    sizes = found.groupBy("item_id").agg(F.count("*").alias("_of"), F.count_if(~F.col("_exact")).alias("_free"))
    return found.join(sizes, "item_id")


def _may_be_known(windows: DataFrame, h: Column) -> Column:
    """Whether the bit of a hash is set in an array of 4,096 longs, which holds for every hash of the windows and few others."""
    full = [0] * 4096
    place = F.shiftright("_hash", 6).bitwiseAND(4095).alias("_place")
    for r in windows.groupBy(place).agg(F.bit_or(F.expr("shiftleft(1L, cast(_hash & 63 as int))")).alias("_set")).collect():
        full[r["_place"]] = r["_set"]
    bits = F.split(F.lit(",".join(map(str, full))), ",").cast("array<bigint>")
    return F.getbit(F.get(bits, F.shiftright(h, 6).bitwiseAND(4095).cast("int")), h.bitwiseAND(63).cast("int")) == 1


def leaked_items(
    docs: DataFrame, items: DataFrame, *, text: str = "text", item_key: str = "item_id", item_text: str = "text", width: int = 8,
    least_words: int = 5, least_windows: int = 6,
) -> DataFrame:
    """Per different text (_k1, _k2) and item found in it: n_windows, share, n_slots, n_changed.

    A text holds an item if at one alignment at least ``least_windows`` windows agree (all template windows but one, for an
    item with fewer, as its first word may read as a name inside a sentence), and if either equal values of the item stand
    for equal values of the text, or so many windows agree without any changed value, and these are half of the item's or
    twice ``least_windows``. Windows mostly of slots, and items of fewer than ``width`` words, agree only verbatim. Every
    window of a text is looked up; texts with a hit are then compared. Null keys, items without words and null texts are
    never found. Copies of a text are looked up once.
    """
    windows = settled(item_windows(items, item_key, item_text, width, least_words))
    # at most one kind more than words in a window
    kinds = [(r["_width"], r["_exact"]) for r in windows.select("_width", "_exact").distinct().orderBy("_width", "_exact").collect()] or [(width, False)]
    body = F.coalesce(F.col(text), F.lit(""))
    hashed = _tokens(docs.select(*text_key(body), body.alias("_text")), F.col("_text"))
    known = F.filter(_every_window(kinds, lambda i, w, h: h), lambda h: _may_be_known(windows, h))
    looked = small_side(windows.select("_hash").distinct())
    hits = hashed.select("_k1", "_k2", F.explode(known).alias("_hash")).join(looked, "_hash").select("_k1", "_k2").distinct()
    bodies = docs.select(*text_key(body), body.alias("_text")).join(small_side(hits), ["_k1", "_k2"]).groupBy("_k1", "_k2").agg(
        F.first("_text").alias("_text"))
    tokens = _tokens(bodies, F.col("_text"))
    every = _every_window(kinds, lambda i, w, h: F.struct(i.alias("spot"), h.alias("hash"), F.slice("_values", i, w).alias("values")))
    met = (
        tokens.select("_k1", "_k2", F.explode(every).alias("_w")).withColumn("_hash", F.col("_w.hash"))
        .join(small_side(windows), "_hash")
        .select("_k1", "_k2", "item_id", "_of", "_free", "_at", (F.col("_w.spot") - F.col("_at")).alias("_shift"), F.transform(
            "_slots", lambda s: F.struct(s["value"].alias("item"), F.get(F.col("_w.values"), s["i"]).alias("text"))).alias("_pairs")))
    pairs = F.array_distinct(F.flatten(F.collect_set("_pairs")))
    kept = F.forall("_pairs", lambda p: p["item"] == p["text"])
    aligned = met.groupBy("_k1", "_k2", "item_id", "_shift", "_of", "_free").agg(
        F.countDistinct("_at").alias("n_windows"), F.countDistinct(F.when(kept, F.col("_at"))).alias("_n_kept"), pairs.alias("_pairs")).withColumn(
        "_same", F.size(F.array_distinct(F.transform("_pairs", lambda p: p["item"]))) == F.size("_pairs"))
    need = F.least(F.lit(least_windows), F.greatest(F.lit(1), F.when(F.col("_free") > 0, F.col("_free")).otherwise(F.col("_of")) - 1))
    verbatim = (F.col("_n_kept") >= need) & ((2 * F.col("_n_kept") >= F.col("_of")) | (F.col("_n_kept") >= 2 * least_windows))
    good = aligned.where((F.col("_same") & (F.col("n_windows") >= need)) | verbatim)
    changed = F.size(F.filter("_pairs", lambda p: p["item"] != p["text"]))
    best = F.max(F.struct("n_windows", -changed, F.size("_pairs").alias("n_slots"), "_of"))
    return good.groupBy("_k1", "_k2", "item_id").agg(best.alias("_b")).select(
        "_k1", "_k2", "item_id", F.col("_b.n_windows").alias("n_windows"), (F.col("_b.n_windows") / F.col("_b._of")).alias("share"),
        F.col("_b.n_slots").cast("long").alias("n_slots"), (-F.col("_b.col2")).cast("long").alias("n_changed"))


def contaminated(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document and item found in it: ``key``, item_id, n_windows, share, n_slots, n_changed.

    See ``leaked_items`` for the rule. Documents without a find give no row; repeated rows give one each. ``n_changed``
    counts slot values that differ from the item's, so it is above 0 for a re-parameterised item.
    """
    found = small_side(leaked_items(docs, items, text=text, **options))
    keyed = docs.select(F.col(key), *text_key(F.coalesce(F.col(text), F.lit(""))))
    return keyed.join(found, ["_k1", "_k2"]).drop("_k1", "_k2")


def without_leaks(docs: DataFrame, items: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, that hold no item. Columns may have any name."""
    found = small_side(leaked_items(docs, items, text=text, **options).select("_k1", "_k2").distinct())
    keyed = docs.select(F.struct("*").alias("_row"), *text_key(F.coalesce(F.col(text), F.lit(""))))
    return keyed.join(found, ["_k1", "_k2"], "left_anti").select("_row.*")
