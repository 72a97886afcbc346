"""Bronze, silver and gold jobs for credit applications.

``*_table`` functions only declare plans. ``run_*`` functions read, write and
report; each table is written once and reports are computed from what was written.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewarden import vocabulary as v
from scorewarden.operators import cleaning, contract, drift, encoders, features, splits
from scorewarden.operators.audit import audit_row
from scorewarden.sources.readers import read_raw_csv, read_table
from scorewarden.sources.writers import write_by_month, write_counted, write_encoders, write_report, write_table
from scorewarden.storage import settled

STAMPS = ["bronze_load_timestamp", "silver_process_timestamp", "gold_process_timestamp"]


# ---- bronze ---------------------------------------------------------------------
def run_bronze(spark: SparkSession, csv: str, out: str) -> int:
    """Raw text to Parquet; returns the number of rows written."""
    return write_counted(read_raw_csv(spark, csv), out)


# ---- silver ---------------------------------------------------------------------
def cleaned_table(bronze: DataFrame) -> DataFrame:
    """Typed and tidied records, not yet filtered or deduplicated."""
    df = cleaning.trimmed_names(cleaning.without(bronze, v.LEAK))
    df = cleaning.typed(df, dates=[v.DAY], integers=v.INTEGER_COLUMNS, doubles=v.DOUBLE_COLUMNS)
    return cleaning.tidy_levels(df, v.CATEGORY_COLUMNS, v.MERGED_LEVELS)


def unique_table(cleaned: DataFrame) -> DataFrame:
    """Complete keys, one row per case: the latest day, on ties the last loaded, then the largest amount."""
    kept = cleaning.keyed(cleaned, [v.CASE, v.DAY, v.OUTCOME])
    tie = [c for c in (STAMPS[0], "原申辦金額", v.OUTCOME) if c in kept.columns]
    return cleaning.latest_per_key(kept, [v.CASE], [v.DAY, *tie])


def encoded_table(df: DataFrame) -> DataFrame:
    df = cleaning.encode_target(df, v.OUTCOME, v.LABEL, v.TARGET)
    df = cleaning.infer_missing(df, "教育程度", "職業說明", v.EDUCATION_FROM_JOB, "教育程度_是否缺失")
    df = cleaning.fill_label(df, v.FILL_COLUMNS, v.MISSING)
    df = cleaning.split_sentinels(
        df, "車齡", sentinel=v.CAR_AGE_SENTINEL, ceiling=v.CAR_AGE_CEILING, original="車齡_原始", missing="車齡_是否缺失",
        anomaly="車齡_異常旗標", clean="車齡_清理後")
    df = cleaning.encode_binary(df, "性別", "性別_二元", v.SEX)
    df = cleaning.encode_binary(df, "婚姻狀況", "婚姻狀況_二元", v.MARRIAGE)
    df = cleaning.encode_ordinal(df, "教育程度", "教育程度_序位", v.EDUCATION)
    df = cleaning.encode_ordinal(df, "月所得", "月所得_序位", v.INCOME_BANDS)
    df = df.withColumn("月所得_是否缺失", (F.col("月所得") == v.MISSING).cast("int"))
    df = cleaning.encode_bands(df, "年齡", "年齡組", "年齡組_序位", v.AGE_BANDS, v.AGE_LAST_BAND, v.AGE_ORDINALS)
    df = cleaning.clean_count(df, "內部往來次數", "內部往來次數_清理後", "內部往來次數_是否特殊值")
    df = cleaning.clean_count(df, "近半年同業查詢次數", "近半年同業查詢次數_清理後", "近半年同業查詢次數_是否缺失")
    df = cleaning.clean_count(df, "所留市內電話數", "所留市內電話數_清理後")
    return cleaning.log_scaled(df, {
        "原申辦金額": "原申辦金額_log", "車齡_清理後": "車齡_log", "內部往來次數_清理後": "內部往來次數_log",
        "近半年同業查詢次數_清理後": "近半年同業查詢次數_log", "所留市內電話數_清理後": "所留市內電話數_log",
    }, zero_filled=["車齡_清理後"])


def silver_table(bronze: DataFrame) -> DataFrame:
    return encoded_table(unique_table(cleaned_table(bronze))).withColumn(STAMPS[1], F.current_timestamp())


def bronze_checks(bronze: DataFrame) -> DataFrame:
    return contract.bronze_suite(
        bronze, required=v.REQUIRED_COLUMNS, ignored=[*STAMPS, v.LEAK], minimum_rows=v.MIN_TOTAL_ROWS,
        null_limits=v.NULL_RATIO_LIMITS, null_default=v.NULL_RATIO_DEFAULT, allowed=v.ALLOWED_LEVELS,
        outcome=v.OUTCOME, target=v.TARGET, positive_range=v.POSITIVE_RATIO_RANGE, most_other=v.MAX_OTHER_LABEL_RATIO)


def limit_checks(tagged: DataFrame, unseen: DataFrame) -> DataFrame:
    """Check rows for the declared limits of keys, months, values and labels; warnings all."""
    return (
        contract.check_duplicates(tagged, [v.CASE], v.MAX_DUPLICATE_RATIO)
        .unionByName(contract.check_monthly_rows(tagged, v.DAY, v.MIN_MONTHLY_ROWS))
        .unionByName(contract.check_top_levels(tagged, v.HIGH_CARDINALITY, v.MAX_SINGLE_LEVEL_RATIO))
        .unionByName(contract.check_label_drift(tagged, v.DAY, v.LABEL, v.MAX_LABEL_DRIFT))
        .unionByName(contract.check_unseen(unseen, v.MAX_UNSEEN_RATIO)))


def silver_checks(silver: DataFrame) -> DataFrame:
    encoded = [v.LABEL, "性別_二元", "婚姻狀況_二元", *v.ORDINAL_FEATURES]
    return contract.silver_suite(silver, minimum_rows=v.MIN_TOTAL_ROWS, encoded=encoded, label=v.LABEL)


def run_silver(
    spark: SparkSession, bronze_path: str, out: str, reports: str, run_id: str, *, validate: bool = True,
    fail_on_error: bool = False,
) -> str:
    """Validate, clean, deduplicate, encode, write, check what was written, and log the row counts."""
    bronze = read_table(spark, bronze_path)
    status, problems = "PASS", []
    if validate:
        checks = settled(bronze_checks(cleaning.without(bronze, v.LEAK)))
        write_report(checks, f"{reports}/validation", run_id, "bronze")
        status = contract.suite_status(checks).first()["status"]
        # one row per check and column of the contract
        problems = [f"{r['check']} {r['column']}" for r in checks.where("not is_valid").orderBy("check", "column").collect()]
        if status == "FAIL" and fail_on_error:
            raise ValueError(f"input breaks the contract: {problems}")
    # The first count comes from file footers and the last from the write. The middle one reads three columns: observed
    # before the shuffle, it would count a task again that a lost executor makes Spark repeat.
    before, after = bronze.count(), write_counted(silver_table(bronze), out)
    complete = cleaning.keyed(cleaned_table(bronze), [v.CASE, v.DAY, v.OUTCOME]).count()
    if validate:
        write_report(silver_checks(read_table(spark, out)), f"{reports}/validation", run_id, "silver")
    write_report(audit_row(
        spark, run_id=run_id, stage="silver", action="run_silver", input_path=bronze_path, output_path=out,
        rows_before=before, rows_after=after,
        drop_reasons={"missing_key_date_label": before - complete, "duplicate": complete - after},
        warnings=problems if status != "PASS" else []), f"{reports}/audit", run_id, "silver")
    return status


# ---- gold -----------------------------------------------------------------------
def split_table(silver: DataFrame, oot_start: dt.date = v.OOT_START) -> DataFrame:
    return splits.split_at(features.with_month(silver, v.DAY, v.MONTH), v.DAY, oot_start)


def crossed_table(df: DataFrame) -> DataFrame:
    df = features.burden_ratio(
        df, "原申辦金額", "月所得", v.INCOME_MIDPOINTS, v.INCOME_DEFAULT, "月所得_估計值", "負債月所得比")
    return features.products(df, {
        "年齡_婚姻交互": ("年齡", "婚姻狀況_二元"),
        "車齡_金額交互": ("車齡_清理後", "原申辦金額_log"),
        "教育_所得交互": ("教育程度_序位", "月所得_序位"),
    }, zero_filled=["車齡_清理後"])


def scaled_columns(frequency_columns: list[str]) -> list[str]:
    return [*v.NUMERIC_TO_SCALE, *v.CROSS_FEATURES, *(f"{c}_頻率" for c in frequency_columns)]


def gold_table(silver: DataFrame, oot_start: dt.date = v.OOT_START) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Split-tagged feature table and the encoders fitted on its development part only."""
    df = split_table(silver, oot_start)
    dev = lambda d: d.where(F.col("split") == "development")
    frequency = settled(encoders.fit_frequency(dev(df), v.HIGH_CARDINALITY))
    df = crossed_table(encoders.apply_frequency(df, frequency, v.HIGH_CARDINALITY))
    columns = [c for c in scaled_columns(v.HIGH_CARDINALITY) if c in df.columns]
    scaler = settled(encoders.fit_minmax(dev(df), columns))
    df = encoders.apply_minmax(df, scaler, columns)
    names = [*v.ORDINAL_FEATURES, *v.BINARY_FEATURES, *(f"{c}_scaled" for c in columns)]
    final = features.feature_table(df, [*v.KEY_COLUMNS, "split"], names, v.LABEL)
    spark = silver.sparkSession
    fitted = {
        "scaler": scaler,
        "frequency": frequency,
        "ordinal": encoders.ordinal_tables(spark, {"教育程度": v.EDUCATION, "月所得": v.INCOME_BANDS, "年齡組": v.AGE_ORDINALS}),
        "features": spark.createDataFrame(list(enumerate(names)), "place int, feature string"),
        "summary": encoders.fit_summary(dev(df), v.DAY),
    }
    return final, fitted


def run_gold(
    spark: SparkSession, silver_path: str, root: str, run_id: str, *, data_start: dt.date = v.DATA_START,
    oot_start: dt.date = v.OOT_START,
) -> dict[str, str]:
    """Write both parts by month, the windows, the encoders, and drift, unseen, statistics and audit reports."""
    silver = read_table(spark, silver_path)
    final, fitted = gold_table(silver, oot_start)
    paths = {name: f"{root}/{name}" for name in ("features", "windows", "encoders", "reports")}
    paths |= {name: f"{paths['features']}/split={name}" for name in ("development", "oot")}
    write_by_month(final, paths["features"], v.MONTH, first=["split"])  # both parts in one pass
    write_table(splits.rolling_windows(
        spark, data_start, oot_start, v.TRAIN_MONTHS, v.MONITOR_MONTHS, v.STEP_MONTHS), paths["windows"])
    write_encoders(fitted, paths["encoders"])
    tagged = split_table(read_table(spark, silver_path), oot_start).withColumn("_dev", F.col("split") == "development")
    reported = lambda df, name: write_report(df, f"{paths['reports']}/{name}", run_id, "gold")
    report = settled(drift.drift_report(tagged, "_dev", v.HIGH_CARDINALITY, v.NUMERIC_TO_SCALE, v.LABEL))
    reported(report, "drift")
    unseen = settled(drift.unseen_summary(tagged, v.HIGH_CARDINALITY, "_dev"))
    reported(unseen, "unseen")
    development = read_table(spark, paths["development"])
    scaled = [c for c in development.columns if c.endswith("_scaled")]
    reported(drift.number_statistics(development, scaled), "number_statistics")
    reported(drift.level_statistics(development, v.ORDINAL_FEATURES), "level_statistics")
    written = read_table(spark, paths["features"])
    reported(contract.gold_suite(written, split="split", features=[*v.ORDINAL_FEATURES, *v.BINARY_FEATURES]).unionByName(
        limit_checks(tagged, unseen)), "validation")
    critical = drift.drift_summary(report).first()["critical_drift_count"]
    reported(audit_row(
        spark, run_id=run_id, stage="gold", action="run_gold", input_path=silver_path, output_path=root,
        rows_before=silver.count(), rows_after=written.count(),  # both from file footers
        warnings=[f"critical drift in {critical} columns"] if critical else []), "audit")
    return paths
