"""Derived features, interactions and the final feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewarden.functions import guarded_ratio, level_value, month_key


def with_month(df: DataFrame, day: str, out: str) -> DataFrame:
    return df.withColumn(out, month_key(F.col(day)))


def burden_ratio(
    df: DataFrame, value: str, level: str, midpoints: Mapping[str, float], default: float, estimate: str, out: str
) -> DataFrame:
    """Value over the midpoint of a banded quantity, over ``default`` where the midpoint is not positive."""
    middle = level_value(F.col(level), midpoints, float(default))
    return df.withColumns({estimate: middle, out: guarded_ratio(F.col(value), middle, default)})


def products(df: DataFrame, pairs: Mapping[str, tuple[str, str]], zero_filled: Sequence[str] = ()) -> DataFrame:
    """New column = left x right; nulls of the ``zero_filled`` columns count as 0."""
    def factor(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0.0)) if c in zero_filled else F.col(c)
    return df.withColumns({out: factor(a) * factor(b) for out, (a, b) in pairs.items()})


def feature_table(df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str) -> DataFrame:
    """Keys, features as doubles with null as 0, and the target, in one projection.

    Text flags such as a Y/N lien are not numbers; they keep their text and fill with '0'.
    """
    kinds = dict(df.dtypes)

    def filled(c: str) -> Column:
        empty = F.lit("0") if kinds[c] == "string" else F.lit(0.0)
        return F.coalesce(F.col(c) if kinds[c] == "string" else F.col(c).cast("double"), empty).alias(c)

    present = [c for c in features if c in df.columns]
    return df.select(*(k for k in keys if k in df.columns), *map(filled, present), target)


def model_columns(df: DataFrame, excluded: Sequence[str], pruned: Sequence[str] = ()) -> list[str]:
    """Names left after the keys, raw levels and pruned features are taken out."""
    skip = {*excluded, *pruned}
    return [c for c in df.columns if c not in skip]


def assembled(df: DataFrame, columns: Sequence[str], label: str, out: str = "features") -> DataFrame:
    """Vector column and double label; null and NaN features count as 0, rows without label are left out."""
    clean = {
        f"_x{i}": F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for i, c in enumerate(columns)
    }
    return (
        VectorAssembler(inputCols=list(clean), outputCol=out)
        .transform(df.where(F.col(label).isNotNull()).withColumns(clean))
        .withColumn(label, F.col(label).cast("double"))
        .drop(*clean)
    )


def classify_features(df: DataFrame, name: str, classes: Sequence[tuple[Sequence[str], str]], out: str) -> DataFrame:
    """First class, in order of priority, one of whose texts occurs in the feature's name."""
    chain = F.lit("other")
    for texts, label in reversed(list(classes)):
        hit = F.lit(False)
        for text in texts:
            hit = hit | F.contains(F.col(name), F.lit(text))
        chain = F.when(hit, label).otherwise(chain)
    return df.withColumn(out, chain)
