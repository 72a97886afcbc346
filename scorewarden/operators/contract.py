"""A data contract compiled to a few aggregates; every check yields rows.

Check rows: (check, column, code, severity, is_valid, message, details). The
codes and severities are fixed values; the texts are this package's own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scorewarden.functions import flag, month_key, ratio

CHECK_SCHEMA = (
    "check string, column string, code string, severity string, is_valid boolean, message string, "
    "details map<string,string>"
)
SEVERITY_RANK = {"INFO": 0, "WARNING": 1, "ERROR": 2, "FATAL": 3}

# Code -> (severity, meaning, what to do)
CATALOGUE = {
    "SCH001": ("FATAL", "required columns are missing", "stop and ask the data owner to repair the source"),
    "SCH002": ("ERROR", "a column has another type than declared", "try to cast, stop if that fails"),
    "SCH003": ("WARNING", "undeclared columns are present", "record and continue"),
    "DQ001": ("ERROR", "a null ratio exceeds its limit", "check the source before going on"),
    "DQ002": ("ERROR", "too few rows", "confirm that the data is complete"),
    "DQ003": ("WARNING", "values outside the allowed list", "record and treat as other"),
    "DQ004": ("WARNING", "numbers outside the declared range", "record"),
    "DR001": ("WARNING", "a distribution drifted", "record and watch model quality"),
    "DR002": ("WARNING", "too many values never seen in development", "consider refitting the encoders"),
    "LB001": ("ERROR", "the share of positive labels is out of range", "confirm that the process did not change"),
    "LB002": ("FATAL", "there are no labels", "stop"),
    "LB003": ("WARNING", "too many outcomes are neither positive nor negative", "record"),
    "SLV001": ("ERROR", "encoded columns are missing", "repair the encoding step"),
    "SLV002": ("ERROR", "labels other than 0 and 1", "repair the target encoding"),
    "GLD001": ("FATAL", "the development part is empty", "stop"),
    "GLD002": ("WARNING", "the out-of-time part is empty", "record"),
    "GLD003": ("ERROR", "features still contain nulls", "repair the feature step"),
}


def catalogue(spark: SparkSession) -> DataFrame:
    rows = [(code, *entry) for code, entry in CATALOGUE.items()]
    return spark.createDataFrame(rows, "code string, severity string, meaning string, action string")


def _row(check: str, column, code: str, ok: Column, details: Mapping[str, Column], severity: str | None = None) -> Column:
    """One check row as a struct: the code's severity and meaning where it fails, INFO where it holds.

    A warning keeps its code but leaves the row valid.
    """
    bad, meaning, _ = CATALOGUE[code]
    bad = severity or bad
    pairs = [x for k, v in details.items() for x in (F.lit(k), v.cast("string"))]
    return F.struct(
        F.lit(check).alias("check"),
        (column if isinstance(column, Column) else F.lit(column)).cast("string").alias("column"),
        F.when(~ok, code).alias("code"),
        F.when(ok, "INFO").otherwise(bad).alias("severity"),
        (F.lit(True) if bad == "WARNING" else ok).alias("is_valid"),
        F.when(ok, "ok").otherwise(meaning).alias("message"),
        F.create_map(*pairs).alias("details"),
    )


def _rows(df: DataFrame, checks: Sequence[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*checks)))


def _schema_row(spark: SparkSession, check: str, code: str, ok: bool, details: Mapping[str, str]) -> DataFrame:
    return _rows(spark.range(1), [_row(check, None, code, F.lit(ok), {k: F.lit(v) for k, v in details.items()})])


# ---- schema -----------------------------------------------------------------
def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    return _schema_row(df.sparkSession, "required_columns", "SCH001", not missing, {"missing": ", ".join(missing)})


def unexpected_columns(df: DataFrame, declared: Sequence[str], ignored: Sequence[str] = ()) -> DataFrame:
    extra = [c for c in df.columns if c not in {*declared, *ignored}]
    return _schema_row(df.sparkSession, "unexpected_columns", "SCH003", not extra, {"unexpected": ", ".join(extra)})


def column_types(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """One row per declared column that is present; wider types of the same family are accepted."""
    families = {
        "string": {"string"}, "integer": {"int", "bigint"}, "double": {"double", "float"},
        "date": {"date", "timestamp", "timestamp_ntz"},
    }
    actual = dict(df.dtypes)
    checks = [
        _row("column_types", c, "SCH002", F.lit(actual[c] in families[kind]),
             {"expected": F.lit(kind), "actual": F.lit(actual[c])})
        for c, kind in declared.items() if c in actual
    ]
    return _rows(df.sparkSession.range(1), checks)


def compatible(df: DataFrame, required: Sequence[str], fail: bool = True) -> bool:
    missing = [c for c in required if c not in df.columns]
    if missing and fail:
        raise ValueError(f"missing columns: {missing}")
    return not missing


# ---- one aggregate for everything that is a statistic of the whole table ------
def _profile_aggregates(nulls: Sequence[str] = (), ranges: Sequence[str] = ()) -> list[Column]:
    def as_map(parts: Sequence[tuple[str, Column]], kind: str) -> Column:
        if not parts:
            return F.create_map().cast(f"map<string,{kind}>")
        return F.create_map(*(x for c, e in parts for x in (F.lit(c), e.cast(kind))))
    return [
        F.count("*").alias("n"),
        as_map([(c, F.count("*") - F.count(F.col(c))) for c in nulls], "bigint").alias("nulls"),
        as_map([(c, F.min(F.col(c))) for c in ranges], "double").alias("lows"),
        as_map([(c, F.max(F.col(c))) for c in ranges], "double").alias("highs"),
    ]


def profile(df: DataFrame, nulls: Sequence[str] = (), ranges: Sequence[str] = ()) -> DataFrame:
    """One row: ``n``, ``nulls`` map column -> null count, ``lows`` and ``highs`` maps."""
    return df.agg(*_profile_aggregates(nulls, ranges))


def null_ratios(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, null_count, null_ratio), all columns in one aggregate."""
    return profile(df, columns or df.columns).select("n", F.explode("nulls").alias("column", "null_count")).select(
        "column", "null_count", ratio(F.col("null_count"), F.col("n")).alias("null_ratio")
    )


def _null_checks(limits: Mapping[str, float], default: float, columns: Sequence[str]) -> list[Column]:
    checks = []
    for c in columns:
        share, limit = ratio(F.col("nulls")[c], F.col("n")), F.lit(float(limits.get(c, default)))
        checks.append(_row("null_ratio", c, "DQ001", ~(share > limit), {"null_ratio": share, "threshold": limit}))
    return checks


def check_null_ratios(df: DataFrame, limits: Mapping[str, float], default: float = 0.30) -> DataFrame:
    return _rows(profile(df, df.columns), _null_checks(limits, default, df.columns))


def _row_count_check(minimum: int) -> Column:
    return _row("row_count", None, "DQ002", F.col("n") >= minimum, {"rows": F.col("n"), "minimum": F.lit(minimum)})


def check_row_count(df: DataFrame, minimum: int) -> DataFrame:
    return _rows(profile(df), [_row_count_check(minimum)])


def check_ranges(df: DataFrame, ranges: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Smallest and largest value of each column against its declared range."""
    present = {c: r for c, r in ranges.items() if c in df.columns}
    checks = []
    for c, (low, high) in present.items():
        lo, hi = F.col("lows")[c], F.col("highs")[c]
        outside = (F.coalesce(lo < low, F.lit(False)) if low is not None else F.lit(False)) | (
            F.coalesce(hi > high, F.lit(False)) if high is not None else F.lit(False))
        checks.append(_row("numeric_range", c, "DQ004", ~outside, {
            "actual_min": lo, "actual_max": hi, "expected_min": F.lit(low), "expected_max": F.lit(high)}))
    return _rows(profile(df, ranges=list(present)), checks)


# ---- levels and labels --------------------------------------------------------
def unexpected_levels(df: DataFrame, allowed: Mapping[str, Sequence[str | None]]) -> DataFrame:
    """(column, value, n) of values outside the allowed lists; null only passes where listed."""
    present = [c for c in allowed if c in df.columns]
    rows = [(c, v) for c in present for v in allowed[c]]
    listed = df.sparkSession.createDataFrame(rows, "column string, value string")  # as long as the declared lists
    counts = (
        df.select(*(F.col(c).cast("string").alias(c) for c in present))
        .unpivot([], present, "column", "value")
        .groupBy("column", "value").agg(F.count("*").alias("n")).alias("seen")
    )
    same = (F.col("seen.column") == F.col("ok.column")) & F.col("seen.value").eqNullSafe(F.col("ok.value"))
    return counts.join(F.broadcast(listed.alias("ok")), same, "left_anti")


def check_levels(df: DataFrame, allowed: Mapping[str, Sequence[str | None]]) -> DataFrame:
    """One row per column with a list: how many distinct values and rows fall outside it.

    The offending values themselves may be many; ``unexpected_levels`` lists them.
    """
    present = [(c,) for c in allowed if c in df.columns]
    columns = df.sparkSession.createDataFrame(present, "column string")
    found = unexpected_levels(df, allowed).groupBy("column").agg(
        F.count("*").alias("levels"), F.sum("n").alias("rows"))
    joined = columns.join(found, "column", "left").na.fill(0)
    return joined.select(F.inline(F.array(_row(
        "allowed_levels", F.col("column"), "DQ003", F.col("levels") == 0,
        {"unexpected_levels": F.col("levels"), "rows": F.col("rows")}))))


def _label_aggregates(outcome: str, table: Mapping[str, int]) -> list[Column]:
    value = F.col(outcome)
    positive = [k for k, v in table.items() if v == 1]
    return [
        F.coalesce(F.sum(flag(value.isin(*positive))), F.lit(0)).alias("positive"),
        F.coalesce(F.sum(flag(value.isNotNull() & ~value.isin(*table))), F.lit(0)).alias("other"),
    ]


def _label_check(outcome: str, low: float, high: float, other: float) -> Column:
    share, foreign = ratio(F.col("positive"), F.col("n")), ratio(F.col("other"), F.col("n"))
    details = {"n": F.col("n"), "positive_ratio": share, "other_ratio": foreign}
    return (
        F.when(F.col("n") == 0, _row("labels", outcome, "LB002", F.lit(False), details))
        .when((share < low) | (share > high), _row("labels", outcome, "LB001", F.lit(False), details))
        .otherwise(_row("labels", outcome, "LB003", ~(foreign > other), details)))


def label_counts(df: DataFrame, outcome: str, table: Mapping[str, int]) -> DataFrame:
    """One row: rows, positive rows, rows with an outcome outside the table (nulls are in rows only)."""
    return df.agg(F.count("*").alias("n"), *_label_aggregates(outcome, table)).select(
        "*", ratio(F.col("positive"), F.col("n")).alias("positive_ratio"),
        ratio(F.col("other"), F.col("n")).alias("other_ratio"),
    )


def check_labels(
    df: DataFrame, outcome: str, table: Mapping[str, int], low: float = 0.05, high: float = 0.95, other: float = 0.05
) -> DataFrame:
    """No rows, else positive share out of range, else too many other outcomes: the first that fails."""
    return _rows(label_counts(df, outcome, table), [_label_check(outcome, low, high, other)])


# ---- limits that are declared but never enforced upstream ---------------------
def duplicate_ratio(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys and (rows - keys) / rows."""
    keys = df.groupBy(*key).agg(F.count("*").alias("c"))
    return keys.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("keys")).select(
        "n", "keys", ratio(F.col("n") - F.col("keys"), F.col("n")).alias("duplicate_ratio"))


def check_duplicates(df: DataFrame, key: Sequence[str], limit: float = 0.01) -> DataFrame:
    return duplicate_ratio(df, key).select(F.inline(F.array(_row(
        "duplicates", ", ".join(key), "DQ001", F.col("duplicate_ratio") <= limit,
        {"duplicate_ratio": F.col("duplicate_ratio"), "limit": F.lit(limit)}, "WARNING"))))


def monthly_rows(df: DataFrame, day: str, minimum: int = 50) -> DataFrame:
    return df.groupBy(month_key(F.col(day)).alias("month")).agg(F.count("*").alias("n")).withColumn(
        "enough", F.col("n") >= minimum)


def top_level_share(df: DataFrame, columns: Sequence[str], limit: float = 0.95) -> DataFrame:
    """(column, top_value, top_ratio, within_limit): share of the most frequent value."""
    counts = (
        df.select(*(F.col(c).cast("string").alias(c) for c in columns))
        .unpivot([], list(columns), "column", "value")
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    # largest count first, then smallest value, as one minimum that map tasks can combine
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.coalesce("value", F.lit("")))).alias("top_value"),
        ratio(F.max("n"), F.sum("n")).alias("top_ratio"),
    ).withColumn("within_limit", F.col("top_ratio") <= limit)


def label_drift_by_month(df: DataFrame, day: str, label: str, limit: float = 0.10) -> DataFrame:
    """Positive share per month and its change from the month before."""
    monthly = df.where(F.col(label).isNotNull()).groupBy(month_key(F.col(day)).alias("month")).agg(
        F.count("*").alias("n"), F.avg(F.col(label).cast("double")).alias("positive_ratio"))
    change = F.col("positive_ratio") - F.lag("positive_ratio").over(W.orderBy("month"))  # one row per month
    return monthly.withColumn("change", change).withColumn(
        "within_limit", F.coalesce(F.abs("change") <= limit, F.lit(True)))


def check_monthly_rows(df: DataFrame, day: str, minimum: int = 50) -> DataFrame:
    """One row: how many months have fewer than ``minimum`` rows."""
    months = monthly_rows(df, day, minimum).agg(F.count("*").alias("months"), F.count_if(~F.col("enough")).alias("short"))
    return _rows(months, [_row("monthly_rows", day, "DQ002", F.col("short") == 0, {
        "months": F.col("months"), "short_months": F.col("short"), "minimum": F.lit(minimum)}, "WARNING")])


def check_top_levels(df: DataFrame, columns: Sequence[str], limit: float = 0.95) -> DataFrame:
    """One row per column: whether its most frequent value stays within ``limit`` of the rows."""
    return top_level_share(df, columns, limit).select(F.inline(F.array(_row(
        "top_level", F.col("column"), "DR001", F.col("within_limit"),
        {"value": F.col("top_value"), "ratio": F.col("top_ratio"), "limit": F.lit(limit)}))))


def check_label_drift(df: DataFrame, day: str, label: str, limit: float = 0.10) -> DataFrame:
    """One row: how many months differ from the month before by more than ``limit`` in their positive share."""
    months = label_drift_by_month(df, day, label, limit).agg(
        F.count("*").alias("months"), F.count_if(~F.col("within_limit")).alias("jumps"), F.max(F.abs("change")).alias("largest"))
    return _rows(months, [_row("label_drift", label, "DR001", F.col("jumps") == 0, {
        "months": F.col("months"), "jumps": F.col("jumps"), "largest_change": F.col("largest"), "limit": F.lit(limit)})])


def check_unseen(unseen: DataFrame, limit: float = 0.05) -> DataFrame:
    """One row per line of an unseen-values summary (feature, unseen_ratio): whether the share of rows stays within ``limit``."""
    return unseen.select(F.inline(F.array(_row(
        "unseen_levels", F.col("feature"), "DR002", F.coalesce(F.col("unseen_ratio") <= limit, F.lit(True)),
        {"unseen_ratio": F.col("unseen_ratio"), "limit": F.lit(limit)}))))


# ---- suites -------------------------------------------------------------------
def bronze_suite(
    df: DataFrame, *, required: Sequence[str], ignored: Sequence[str], minimum_rows: int,
    null_limits: Mapping[str, float], null_default: float, allowed: Mapping[str, Sequence[str | None]],
    outcome: str, target: Mapping[str, int], positive_range: tuple[float, float] = (0.05, 0.95), most_other: float = 0.05,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """All checks of raw records. Missing required columns end the suite at once.

    Row count, null ratios and labels come from one aggregate, levels from a second pass.
    """
    first = required_columns(df, required)
    if not compatible(df, required, fail=False):
        return first
    statistics = df.agg(*_profile_aggregates(df.columns), *_label_aggregates(outcome, target))
    whole_table = _rows(statistics, [
        _row_count_check(minimum_rows), *_null_checks(null_limits, null_default, df.columns),
        _label_check(outcome, *positive_range, most_other)])
    suite = (
        first.unionByName(unexpected_columns(df, required, ignored))
        .unionByName(whole_table).unionByName(check_levels(df, allowed)))
    return suite.unionByName(column_types(df, types)) if types else suite


def silver_suite(df: DataFrame, *, minimum_rows: int, encoded: Sequence[str], label: str) -> DataFrame:
    missing = [c for c in encoded if c not in df.columns]
    checks = [_row_count_check(minimum_rows),
              _row("encoded_columns", None, "SLV001", F.lit(not missing), {"missing": F.lit(", ".join(missing))})]
    counts = [F.count("*").alias("n")]
    if label in df.columns:
        counts.append(F.coalesce(F.sum(flag(~F.col(label).isin(0, 1))), F.lit(0)).alias("bad"))
        checks.append(_row("label_values", label, "SLV002", F.col("bad") == 0, {"rows": F.col("bad")}))
    return _rows(df.agg(*counts), checks)


def gold_suite(df: DataFrame, *, split: str, features: Sequence[str]) -> DataFrame:
    """Part sizes and remaining nulls of development features, from one aggregate of the split-tagged table."""
    dev, present = F.col(split) == "development", [c for c in features if c in df.columns]
    stats = df.agg(
        F.coalesce(F.sum(flag(dev)), F.lit(0)).alias("dev"),
        F.coalesce(F.sum(flag(F.col(split) == "oot")), F.lit(0)).alias("oot"),
        *(F.coalesce(F.sum(flag(dev & F.col(c).isNull())), F.lit(0)).alias(f"_{i}") for i, c in enumerate(present)),
    )
    checks = [
        _row("development_rows", None, "GLD001", F.col("dev") > 0, {"rows": F.col("dev")}),
        _row("oot_rows", None, "GLD002", F.col("oot") > 0, {"rows": F.col("oot")}),
        *(_row("feature_nulls", c, "GLD003", F.col(f"_{i}") == 0, {"rows": F.col(f"_{i}")})
          for i, c in enumerate(present)),
    ]
    return _rows(stats, checks)


def suite_status(checks: DataFrame) -> DataFrame:
    """One row: PASS, WARNING or FAIL, and how many rows have each severity."""
    rank = F.coalesce(F.max(F.element_at(F.create_map(*(F.lit(x) for p in SEVERITY_RANK.items() for x in p)),
                                         F.col("severity"))), F.lit(0))
    count = lambda s: F.coalesce(F.sum(flag(F.col("severity") == s)), F.lit(0)).alias(f"{s.lower()}_count")
    return checks.agg(
        F.when(rank >= 2, "FAIL").when(rank == 1, "WARNING").otherwise("PASS").alias("status"),
        *map(count, ("FATAL", "ERROR", "WARNING", "INFO")),
    )
