"""Find personal data: wide generators propose spans, boosted trees on format and context choose among them.

Everything that touches documents is built from SQL functions. The trees are
fitted to counts per combination of features, a table whose size is bounded by
the features and not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewarden.llm.common import settled

KINDS = ("email", "ip", "card", "phone")
# Fixed base patterns, written so that a long run of one class is scanned once: the lookbehind lets a match start only
# where its run starts or the match before has ended, which is where the leftmost match starts.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Further generators: addresses spelled out, and numbers in groups without a leading plus.
SPELLED = (
    r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,64}"
    r"(?:\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z]{2,24}){1,4}")
NUMBER = r"(?<![0-9A-Za-z.])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![0-9A-Za-z])"
#: (pattern, what a text must have for it to be tried, kind that a chosen span gets)
GENERATORS = (
    (EMAIL, lambda t: F.contains(t, F.lit("@")), 0), (IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), 1), (CARD, lambda t: t.rlike("[0-9]"), 2),
    (PHONE, lambda t: F.contains(t, F.lit("+")), 3), (SPELLED, lambda t: F.contains(F.lower(t), F.lit("dot")) | F.contains(F.lower(t), F.lit("(at)")) | F.contains(F.lower(t), F.lit("[at]")), 0),
    (NUMBER, lambda t: t.rlike("[0-9]"), 3),
)
#: Words before a find, by what they hint at; the last class speaks against personal data.
CONTEXT = (
    r"(?i)(?:phone|tel|call|mobile|fax|cell)\W*\w{0,3}\W*\z", r"(?i)(?:mail|contact|write|reach)\W*\w{0,3}\W*\z",
    r"(?i)(?:card|visa|credit|account|iban)\W*\w{0,3}\W*\z", r"(?i)(?:ip|host|server|address)\W*\w{0,3}\W*\z",
    r"(?i)(?:version|section|page|isbn|chapter|no|nr|id)\W*\w{0,3}\W*\z")
FEATURES = {"generator": 6, "digits": 7, "marks": 6, "context": 6, "before": 4, "after": 4}
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: The digit sum of the double of each digit.
_DOUBLED = "0246813579"


def proposals(text: str, pattern: str, wanted) -> Column:
    """All matches of a pattern with start, value, and up to 24 characters before and 8 after them."""
    column = F.col(text)
    values = F.regexp_extract_all(column, F.lit(pattern), F.lit(0))
    gaps = F.split(column, pattern, -1)

    def placed(parts: Column) -> Column:
        values, gaps = parts["values"], parts["gaps"]
        zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("starts"))
        lengths = F.transform(values, lambda v, i: F.struct(F.char_length(F.get(gaps, i)).alias("gap"), F.char_length(v).alias("long")))
        starts = F.aggregate(lengths, zero, lambda s, x: F.struct(
            (s["at"] + x["gap"] + x["long"]).alias("at"), F.array_append(s["starts"], s["at"] + x["gap"]).alias("starts")), lambda s: s["starts"])
        return F.element_at(F.transform(F.array(starts), lambda starts: F.transform(values, lambda v, i: F.struct(
            F.get(starts, i).alias("start"), v.alias("value"), F.right(F.get(gaps, i), F.lit(24)).alias("before"),
            F.left(F.get(gaps, i + 1), F.lit(8)).alias("after")))), 1)

    found = F.element_at(F.transform(F.array(F.struct(values.alias("values"), gaps.alias("gaps"))), placed), 1)
    empty = F.expr("cast(array() as array<struct<start:int,value:string,before:string,after:string>>)")
    return F.when(wanted(column) & column.rlike(pattern), found).otherwise(empty)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Check sum of up to 20 digits; every second one from the right counts as the digit sum of its double."""
    padded = F.lpad(digits, 20, "0")
    total = F.lit(0)
    for i in range(1, 21):
        digit = F.substring(padded, i, 1)
        total = total + (F.translate(digit, "0123456789", _DOUBLED) if i % 2 else digit).cast("int")
    return total % 10 == 0


def holds_rule(kind: int, value: Column) -> Column:
    """The rule a base match must pass; it is dropped otherwise."""
    if kind == 0:
        return F.lit(True)
    if kind == 1:
        return value.rlike(rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z")
    n = F.length(digits_of(value))
    return n.between(16, 19) & passes_luhn(digits_of(value)) if kind == 2 else n.between(8, 15)


def feature_codes(generator: int, p: Column) -> Column:
    """Small numbers that say how a proposal looks and where it stands; see ``FEATURES`` for how many values each has."""
    value, before, after = p["value"], p["before"], p["after"]
    n = F.length(digits_of(value))
    digits = F.lit(0)
    for limit in (1, 8, 10, 12, 16, 20):
        digits = digits + (n >= limit).cast("int")
    seps = [F.contains(value, F.lit(c)).cast("int") for c in (" ", "-", ".", "(")]
    marks = F.when(seps[0] + seps[1] + seps[2] + seps[3] > 1, 5)
    for i, s in enumerate(seps):
        marks = marks.when(s == 1, i + 1)
    context = F.when(before.rlike(CONTEXT[0]), 1)
    for i, pattern in enumerate(CONTEXT[1:], 2):
        context = context.when(before.rlike(pattern), i)

    def side(c: Column) -> Column:
        return F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike("[A-Za-z0-9]"), 2).otherwise(3)
    codes = (F.lit(generator), digits, marks.otherwise(0), context.otherwise(0), side(F.right(before, F.lit(1))), side(F.left(after, F.lit(1))))
    return F.struct(*(c.cast("int").alias(n) for n, c in zip(FEATURES, codes, strict=True)))


def boosted_trees(x: np.ndarray, good: np.ndarray, bad: np.ndarray, *, trees: int, depth: int, rate: float, least: float) -> list:
    """Gradient-boosted trees for weighted rows of small whole numbers, by logistic loss.

    A tree is a number or (feature, bound, tree for values up to the bound, tree for larger ones).
    """
    score = np.zeros(len(x))

    def grow(rows: np.ndarray, level: int, gradient: np.ndarray, curve: np.ndarray):
        g, h = gradient[rows].sum(), curve[rows].sum()
        best, cut = 1e-6, None
        for f in range(x.shape[1]) if level else ():
            for bound in np.unique(x[rows, f])[:-1]:
                low = rows[x[rows, f] <= bound]
                gl, hl = gradient[low].sum(), curve[low].sum()
                if hl < least or h - hl < least:
                    continue
                gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                if gain > best:
                    best, cut = gain, (f, int(bound))
        if cut is None:
            return float(-rate * g / (h + 1))
        low = x[rows, cut[0]] <= cut[1]
        return (*cut, grow(rows[low], level - 1, gradient, curve), grow(rows[~low], level - 1, gradient, curve))

    out = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        weight = good + bad
        tree = grow(np.arange(len(x)), depth, p * weight - good, np.maximum(p * (1 - p) * weight, 1e-9))
        out.append(tree)
        score = score + tree_scores(tree, x)
    return out


def tree_scores(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, bound, low, high = tree
    return np.where(x[:, f] <= bound, tree_scores(low, x), tree_scores(high, x))


def tree_column(tree, codes: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    f, bound, low, high = tree
    return F.when(codes[list(FEATURES)[f]] <= bound, tree_column(low, codes)).otherwise(tree_column(high, codes))


def calibrated_cut(scores: np.ndarray, good: np.ndarray, bad: np.ndarray, precision: float, least: float) -> float:
    """The lowest score from which on the share of good ones among held-out rows is at least ``precision``; infinite if none."""
    order = np.argsort(-scores, kind="stable")
    g, b, s = np.cumsum(good[order]), np.cumsum(bad[order]), scores[order]
    last = np.r_[s[1:] != s[:-1], True]
    fits = last & (g >= precision * (g + b)) & (g + b >= least)
    return float(s[np.flatnonzero(fits)[-1]]) if fits.any() else float("inf")


def overlaps(spans: Column, p: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < p["end"]) & (p["start"] < s["end"]))


def personal_spans(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", trees: int = 20, depth: int = 3, rate: float = 0.3, precision: float = 0.95,
    least: float = 20.0,
) -> DataFrame:
    """One row per document: ``key``, _base and _spans, arrays of (kind, start, end) in order; kind is an index into ``KINDS``.

    Base spans are the matches of the four base patterns that pass their rule; they always stay. All other proposals are
    scored by boosted trees. These learn from every proposal of the documents: base matches that pass their rule are good,
    and so is what the further generators find over a base span; the rest is bad. Half of the documents, by a hash of the key, fit the trees; the other half sets for each generator
    the score from which at least ``precision`` of ``least`` or more proposals were good, and proposals from that score
    on are added unless they overlap a base span. Offsets are code points of the whole text, ends exclusive. A null text
    has no spans. Repeated rows are documents of their own; other columns are left out; an empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
    rows = rows.withColumns({f"_g{i}": proposals("_text", pattern, wanted) for i, (pattern, wanted, _) in enumerate(GENERATORS)})
    rows = settled(rows.drop("_text"))

    def spans(i: int, kind: int, keep) -> Column:
        return F.transform(F.filter(f"_g{i}", keep), lambda p: F.struct(
            F.lit(kind).alias("kind"), p["start"].alias("start"), (p["start"] + F.char_length(p["value"])).alias("end")))

    base = F.concat(*(spans(i, i, _rule(i)) for i in range(len(KINDS))))
    rows = rows.withColumn("_base", base)

    def described(i: int) -> Column:
        kind = GENERATORS[i][2]
        # a long number without a plus is more like a card
        named = (lambda p: F.when(F.length(digits_of(p["value"])) >= 13, 2).otherwise(3)) if i == 5 else (lambda p: F.lit(kind))
        return F.transform(f"_g{i}", lambda p: F.struct(
            named(p).alias("kind"), p["start"].alias("start"), (p["start"] + F.char_length(p["value"])).alias("end"), feature_codes(i, p).alias("codes"),
            (holds_rule(i, p["value"]) if i < len(KINDS) else F.lit(False)).alias("valid"), F.lit(i >= len(KINDS)).alias("free")))

    every = rows.withColumn("_all", F.concat(*(described(i) for i in range(len(GENERATORS)))))
    counted = every.select((F.pmod(F.xxhash64("_key"), F.lit(2)) == 0).alias("_fit"), "_base", F.explode("_all").alias("_p")).select(
        "_fit", "_p.codes.*", (F.col("_p.valid") | (F.col("_p.free") & overlaps(F.col("_base"), F.col("_p")))).cast("long").alias("_good"))
    # at most one row per combination of feature values and half
    cells = counted.groupBy("_fit", *FEATURES).agg(F.sum("_good").alias("_good"), F.count("*").alias("_n")).orderBy("_fit", *FEATURES).collect()
    model, cuts = fitted_model([tuple(c) for c in cells], trees, depth, rate, precision, least)
    extra = F.expr("cast(array() as array<struct<kind:int,start:int,end:int>>)")
    if model and any(np.isfinite(cuts)):
        def chosen(p: Column) -> Column:
            total = F.lit(0.0)
            for tree in model:
                total = total + tree_column(tree, p["codes"])
            cut = F.element_at(F.array(*(F.lit(float(c)) for c in cuts)), p["codes"]["generator"] + 1)
            return ~overlaps(F.col("_base"), p) & (total >= cut)
        extra = F.transform(F.filter("_all", chosen), lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    out = every.withColumn("_spans", F.array_sort(F.array_distinct(F.concat("_base", extra))))
    return out.select(F.col("_key").alias(key), F.array_sort("_base").alias("_base"), "_spans")


def _rule(kind: int):
    return lambda p: holds_rule(kind, p["value"])


def fitted_model(cells: Sequence[tuple], trees: int, depth: int, rate: float, precision: float, least: float) -> tuple[list, list[float]]:
    """Trees from the fitting half of the cells (fit, features..., good, all), and a cut per generator from the other half."""
    table = np.array([c[1:] for c in cells], np.int64).reshape(len(cells), len(FEATURES) + 2)
    half = np.array([bool(c[0]) for c in cells], bool)
    x, good = table[:, : len(FEATURES)], table[:, -2].astype(float)
    bad = table[:, -1] - good
    if not half.any() or half.all():
        return [], []
    model = boosted_trees(x[half], good[half], bad[half], trees=trees, depth=depth, rate=rate, least=1.0)
    scores = sum(tree_scores(t, x[~half]) for t in model)
    cuts = []
    for g in range(len(GENERATORS)):
        own = x[~half][:, 0] == g
        cuts.append(calibrated_cut(scores[own], good[~half][own], bad[~half][own], precision, least))
    return model, cuts
