"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "add_all", "amount", "any_of", "band", "blank_to_null", "bucket_of", "flag", "guarded_ratio",
    "joined_reasons", "level_code", "level_value", "month_key", "month_number", "null_text", "parse_day",
    "ratio", "score_zone", "verdict", "whole_number", "zone_label", "f1_of", "population_stability",
]


def add_all(terms: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def any_of(terms: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, terms)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def ratio(part: Column, whole: Column, empty: float | None = 0.0) -> Column:
    """part / whole as double, or ``empty`` when the denominator is zero or null."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(empty).cast("double"))


# ---- text, dates, numbers ---------------------------------------------------
def null_text(col: Column, words: Sequence[str] = ("NULL", "")) -> Column:
    """Turn placeholder text, compared without case, into a real null."""
    return F.when(F.upper(col).isin(*words), None).otherwise(col)


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def parse_day(col: Column, pattern: str = "yyyyMMdd") -> Column:
    """Date from text, null instead of an error when the text does not fit."""
    return F.try_to_date(col.cast("string"), pattern)


def whole_number(col: Column) -> Column:
    return null_text(col).try_cast("int")


def amount(col: Column) -> Column:
    return null_text(col).try_cast("double")


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_number(day: Column) -> Column:
    """Months counted from year zero, so that differences are calendar months."""
    return F.year(day) * 12 + F.month(day)


# ---- encodings --------------------------------------------------------------
def level_value(col: Column, table: Mapping, default=None) -> Column:
    """Look a level up in a short fixed table held in the plan as one map literal."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    found = F.element_at(F.create_map(*entries), col)
    return found if default is None else F.coalesce(found, F.lit(default))


def level_code(col: Column, table: Mapping[str, int], default: int = 0) -> Column:
    return level_value(col, table, default)


def band(col: Column, uppers: Sequence[tuple[float, str]], last: str) -> Column:
    """Name of the first band whose exclusive upper bound exceeds the value."""
    chain = F.when(col < uppers[0][0], uppers[0][1])
    for upper, name in uppers[1:]:
        chain = chain.when(col < upper, name)
    return chain.otherwise(last)


def guarded_ratio(part: Column, whole: Column, fallback: float) -> Column:
    """part / whole where the denominator is positive, else part / fallback."""
    return part / F.when(whole > 0, whole).otherwise(F.lit(float(fallback)))


def bucket_of(value: Column, edges: Column, size: int) -> Column:
    """How many of the first ``size`` sorted edges are at or below the value."""
    return add_all(flag(value >= F.get(edges, F.lit(i))) for i in range(size)) if size else F.lit(0)


# ---- routing ----------------------------------------------------------------
def score_zone(score: Column, lower, upper) -> Column:
    """2 at or above upper, 0 below lower, 1 in between; below wins if they cross.

    Spark orders NaN above every number, so it is sent to manual review explicitly.
    """
    lower, upper = (x if isinstance(x, Column) else F.lit(float(x)) for x in (lower, upper))
    return F.when(F.isnan(score), 1).when(score < lower, 0).when(score >= upper, 2).otherwise(1)


def zone_label(zone: Column, names: Mapping[int, str]) -> Column:
    return level_value(zone, names)


# ---- judgement --------------------------------------------------------------
def verdict(delta: Column, higher_is_better: Column, tolerance: float = 0.001) -> Column:
    gain = F.when(higher_is_better, delta).otherwise(-delta)
    return F.when(gain > tolerance, "IMPROVED").when(gain < -tolerance, "REGRESSED").otherwise("UNCHANGED")


def joined_reasons(*pairs: tuple[Column, Column]) -> Column:
    """'; '-joined texts of the conditions that hold; unknown counts as not holding."""
    return F.concat_ws("; ", *(F.when(condition, text) for condition, text in pairs))


def f1_of(hit: Column, false_alarm: Column, miss: Column) -> Column:
    return ratio(2 * hit, 2 * hit + false_alarm + miss)


def population_stability(expected: Sequence[Column], actual: Sequence[Column], floor: float = 1e-10) -> Column:
    """Sum of (a - e) ln(a / e) over aligned shares, each share at least ``floor``."""
    def term(e: Column, a: Column) -> Column:
        e, a = F.greatest(e, F.lit(floor)), F.greatest(a, F.lit(floor))
        return (a - e) * F.log(a / e)
    return add_all(term(e, a) for e, a in zip(expected, actual, strict=True))
