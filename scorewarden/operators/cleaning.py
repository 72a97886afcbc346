"""Text to typed columns, sentinels to nulls, one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scorewarden.functions import amount, band, blank_to_null, flag, level_code, parse_day, whole_number


def replaced(df: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    """Apply the changes of columns that exist, all in one projection."""
    return df.withColumns({c: e for c, e in changes.items() if c in df.columns})


def trimmed_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.strip() for c in df.columns))


def without(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def typed(
    df: DataFrame, *, dates: Sequence[str] = (), integers: Sequence[str] = (), doubles: Sequence[str] = (),
    date_pattern: str = "yyyyMMdd",
) -> DataFrame:
    """Cast text columns; text that does not fit becomes null."""
    return replaced(df, {
        **{c: parse_day(F.col(c), date_pattern) for c in dates},
        **{c: whole_number(F.col(c)) for c in integers},
        **{c: amount(F.col(c)) for c in doubles},
    })


def tidy_levels(
    df: DataFrame, columns: Sequence[str], merged: Mapping[str, Mapping[str, str]] | None = None
) -> DataFrame:
    """Trim, turn blanks into nulls, and fold some levels into others."""
    def tidy(c: str) -> Column:
        level = blank_to_null(F.col(c))
        for old, new in (merged or {}).get(c, {}).items():
            level = F.when(level == old, new).otherwise(level)
        return level
    return replaced(df, {c: tidy(c) for c in columns})


def keyed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of every key with the largest ``order`` columns.

    ``order`` should end in a tie-break that is unique within a key. Spark limits
    each map task to its first row per key before the shuffle, so a key that
    holds a third of the table sends one row per task like any other.
    """
    newest = W.partitionBy(*key).orderBy(*(F.desc(c) for c in order))
    return df.withColumn("_place", F.row_number().over(newest)).where("_place = 1").drop("_place")


def encode_target(df: DataFrame, outcome: str, label: str, table: Mapping[str, int]) -> DataFrame:
    """Label from the outcome; an outcome outside the table gives a null label."""
    chain = F.lit(None).cast("int")
    for level, code in table.items():
        chain = F.when(F.col(outcome) == level, code).otherwise(chain)
    return df.withColumn(label, chain)


def infer_missing(df: DataFrame, column: str, hint: str, rules: Mapping[str, str], flag_name: str) -> DataFrame:
    """Flag nulls, then fill them where another column contains a rule's text."""
    value = F.col(column)
    for text, guess in reversed(list(rules.items())):
        value = F.when(F.col(column).isNull() & F.col(hint).contains(text), guess).otherwise(value)
    return df.withColumns({flag_name: flag(F.col(column).isNull()), column: value})


def fill_label(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    return replaced(df, {c: F.coalesce(F.col(c), F.lit(label)) for c in columns})


def split_sentinels(
    df: DataFrame, column: str, *, sentinel: float, ceiling: float, original: str, missing: str, anomaly: str, clean: str
) -> DataFrame:
    """Keep the value, flag the sentinel and values above the ceiling, null both and negatives out."""
    value = F.col(column)
    return df.withColumns({
        original: value,
        missing: flag(value == sentinel),
        anomaly: flag(value > ceiling),
        clean: F.when((value == sentinel) | (value < 0) | (value > ceiling), None).otherwise(value),
    })


def encode_binary(df: DataFrame, column: str, out: str, table: Mapping[str, int]) -> DataFrame:
    return df.withColumn(out, level_code(F.col(column), table, 0))


def encode_ordinal(df: DataFrame, column: str, out: str, table: Mapping[str, int], default: int = 0) -> DataFrame:
    return df.withColumn(out, level_code(F.col(column), table, default))


def encode_bands(
    df: DataFrame, column: str, out: str, code: str, uppers: Sequence[tuple[float, str]], last: str,
    ordinals: Mapping[str, int],
) -> DataFrame:
    named = band(F.col(column), uppers, last)
    return df.withColumns({out: named, code: level_code(named, ordinals)})


def clean_count(df: DataFrame, column: str, clean: str, special: str | None = None, sentinel: int = -1) -> DataFrame:
    """Negative counts become 0, nulls stay null; optionally flag the sentinel."""
    value = F.col(column)
    new = {clean: F.when(value < 0, 0).otherwise(value)}
    if special:
        new[special] = flag(value == sentinel)
    return df.withColumns(new)


def log_scaled(df: DataFrame, pairs: Mapping[str, str], zero_filled: Sequence[str] = ()) -> DataFrame:
    """log(1 + x) of source column -> new column; some sources count null as 0."""
    def source(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0.0)) if c in zero_filled else F.col(c)
    return df.withColumns({out: F.log1p(source(c)) for c, out in pairs.items()})
