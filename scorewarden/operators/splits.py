"""Time splits, rolling windows and month folds. All add columns; none scans twice."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewarden.functions import month_key
from scorewarden.operators.ordering import values_at_ranks
from scorewarden.storage import small_side


def split_at(df: DataFrame, day: str, cut: dt.date, out: str = "split") -> DataFrame:
    return df.withColumn(out, F.when(F.col(day) < F.lit(cut), "development").otherwise("oot"))


def rolling_windows(
    spark: SparkSession, start: dt.date, cut: dt.date, train: int = 4, monitor: int = 2, step: int = 2
) -> DataFrame:
    """Window definitions whose monitor period ends before ``cut``."""
    first, last = f"date'{start}'", f"date'{cut}'"
    return (
        spark.range(1)
        .selectExpr(f"posexplode(sequence({first}, {last}, interval {step} month)) as (place, train_start)")
        .selectExpr(
            "cast(place + 1 as int) as window_id",
            "train_start",
            f"date_sub(add_months(train_start, {train}), 1) as train_end",
            f"add_months(train_start, {train}) as monitor_start",
            f"date_sub(add_months(train_start, {train + monitor}), 1) as monitor_end",
        )
        .where(F.col("monitor_end") < F.lit(cut))
    )


def tag_windows(df: DataFrame, windows: DataFrame, day: str) -> DataFrame:
    """One row per (row, window it falls in) with ``window_id`` and ``phase`` train or monitor.

    Windows are unfolded into months, so this is a hash join on the month with
    the exact dates as a residual, and a table partitioned by month is pruned.
    The unfolded table has (months per window) x (windows) rows, all generated
    from the window definitions, which is what makes it safe to broadcast.
    """
    months = windows.select(
        "window_id",
        F.explode(F.array(
            F.struct(F.lit("train").alias("phase"), F.col("train_start").alias("a"), F.col("train_end").alias("b")),
            F.struct(F.lit("monitor").alias("phase"), F.col("monitor_start").alias("a"), F.col("monitor_end").alias("b")),
        )).alias("p"),
    ).selectExpr(
        "window_id", "p.phase as phase", "p.a as _from", "p.b as _to",
        "explode(sequence(trunc(p.a, 'MM'), p.b, interval 1 month)) as _first_day",
    ).withColumn("_month", month_key(F.col("_first_day"))).drop("_first_day")
    return (
        df.withColumn("_month", month_key(F.col(day)))
        .join(F.broadcast(months), "_month")
        .where(F.col(day).cast("date").between(F.col("_from"), F.col("_to")))
        .drop("_month", "_from", "_to")
    )


def three_way_split(
    df: DataFrame, day: str, development: int = 18, policy: int = 4, out: str = "split"
) -> DataFrame:
    """development, policy and holdout counted in months from the first day in the data."""
    first = df.agg(F.min(F.col(day).cast("date")).alias("d")).scalar()
    date = F.col(day).cast("date")
    policy_start = F.add_months(first, development)
    return df.withColumn(
        out,
        F.when(date < policy_start, "development")
        .when(date < F.add_months(policy_start, policy), "policy")
        .otherwise("holdout"),
    )


def _exact_levels(df: DataFrame, key: str) -> list[Column]:
    """Numbers that a double holds exactly and whose order, one after the other, is that of the key.

    Whole numbers go by their upper and lower 32 bits; other keys, such as text, by two seeded hashes, an order as good
    as any to decide ties. Null keys come first.
    """
    kind = dict(df.dtypes)[key]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        value = F.col(key).cast("bigint")
        parts = [F.shiftright(value, 32), value.bitwiseAND((1 << 32) - 1)]
    else:
        parts = [F.shiftright(F.xxhash64(F.lit(seed), F.col(key).cast("string")), 11) for seed in (1, 2)]
    return [F.when(F.col(key).isNull(), F.lit(-1.0 * (1 << 60))).otherwise(p.cast("double")) for p in parts]


def two_thirds_split(
    df: DataFrame, day: str, tie: str, out: str = "split", share: tuple[int, int] = (2, 3)
) -> DataFrame:
    """First floor(2n/3) rows in (day, tie) order are policy, the rest holdout.

    All rows count; those without a day come last. No row is numbered: the day at the cut is found by rank, then the
    last tie value on the near side within that day; these few numbers are literals of the final projection. ``tie``
    must be unique within a day; text keys are ordered by a hash.
    """
    last = 1e9  # after any day
    levels = [F.coalesce(F.unix_date(F.col(day).cast("date")).cast("double"), F.lit(last)), *_exact_levels(df, tie)]
    names = [f"_level{i}" for i in range(len(levels))]
    part, whole = share
    placed = df.select(*(level.alias(n) for level, n in zip(levels, names, strict=True)))
    rank, near, equal = f"cast(floor(n * {part} / {whole}) as bigint) - 1", F.lit(False), F.lit(True)
    for level, name in zip(levels, names, strict=True):
        found = values_at_ranks(placed, name, f"array({rank})").first()
        if not found or not found["picks"]:
            return df.withColumn(out, F.lit("holdout"))
        pick = found["picks"][0]
        near = near | (equal & (level < pick["value"]))
        equal = equal & (level == pick["value"])
        placed = placed.where(F.col(name) == pick["value"])
        rank = f"{pick['rank'] - pick['start']}L"
    return df.withColumn(out, F.when(near | equal, "policy").otherwise("holdout"))

def month_folds(
    df: DataFrame, day: str, by: Sequence[str] = (), first_train: int = 2, n_splits: int = 2
) -> DataFrame:
    """Walk-forward folds: one row per (row, fold) with ``fold`` and ``role`` train or validate.

    Fold k trains on the first ``first_train + k - 1`` months present in the
    group and validates on the next one. Only months are ranked, not rows.
    """
    group = f"partition by {', '.join(f'`{c}`' for c in by)}" if by else ""
    pairs = ", ".join(
        f"case when m < {k + first_train} and last >= {k + first_train} then struct({k} as fold, 'train' as role)"
        f" when m = {k + first_train} then struct({k} as fold, 'validate' as role) end"
        for k in range(1, n_splits + 1)
    )
    dated = df.withColumn("_month", month_key(F.col(day)))
    # months x groups rows, whatever the size of the table
    months = (
        dated.select(*by, "_month").distinct()
        .selectExpr("*", f"dense_rank() over ({group} order by _month) as m")
        .selectExpr("*", f"max(m) over ({group}) as last")
        .selectExpr(*(f"`{c}`" for c in by), "_month", f"inline(filter(array({pairs}), x -> x is not null))")
    )
    return dated.join(small_side(months), [*by, "_month"]).drop("_month")


def retraining_periods(
    df: DataFrame, day: str, development: int = 18, policy: int = 4, holdout: int = 2
) -> DataFrame:
    """Data periods that end on a given day, as yyyy-MM-dd text columns."""
    end = F.col(day).cast("date")
    start = F.add_months(end, -(development + policy + holdout))
    policy_start = F.add_months(start, development)
    holdout_start = F.add_months(policy_start, policy)
    periods = {
        "data_start": start, "data_end": end,
        "development_start": start, "development_end": F.date_sub(policy_start, 1),
        "policy_validation_start": policy_start, "policy_validation_end": F.date_sub(holdout_start, 1),
        "final_holdout_start": holdout_start, "final_holdout_end": end,
    }
    return df.withColumns({c: F.date_format(d, "yyyy-MM-dd") for c, d in periods.items()})


def typed_windows(df: DataFrame) -> DataFrame:
    """Stored window definitions with integer ids and real dates."""
    days = ["train_start", "train_end", "monitor_start", "monitor_end"]
    return df.select(F.col("window_id").cast("int").alias("window_id"), *(F.col(c).cast("date").alias(c) for c in days))


def two_part_periods(df: DataFrame, day: str, development: int = 18, oot: int = 6) -> DataFrame:
    """The older two-part variant: development, then an out-of-time period that ends on the day."""
    end = F.col(day).cast("date")
    oot_start = F.add_months(end, -oot)
    development_end = F.date_sub(oot_start, 1)
    periods = {
        "dev_start": F.date_add(F.add_months(development_end, -development), 1), "dev_end": development_end,
        "oot_start": oot_start, "oot_end": end,
    }
    return df.withColumns({c: F.date_format(d, "yyyy-MM-dd") for c, d in periods.items()})
