"""Null rules and edge rows of raw records."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scorewarden import vocabulary as v
from scorewarden.operators import cleaning, contract
from scorewarden.plans import layers

BASE = {
    "案件編號": "1", "進件日": "20240501", "授信結果": "APP(核准)", "年齡": "30", "性別": "男", "教育程度": "大學", "婚姻狀況": "已婚",
    "月所得": "~20,000", "職業說明": "工", "居住地": "北", "廠牌車型": "A", "原申辦金額": "100", "申辦期數": "12", "車齡": "3",
    "動產設定": "Y", "內部往來次數": "2", "近半年同業查詢次數": "1", "所留市內電話數": "1",
}


def records(spark, *changes):
    rows = [{**BASE, "案件編號": str(i), **c} for i, c in enumerate(changes)]
    schema = ", ".join(f"`{c}` string" for c in v.REQUIRED_COLUMNS)
    return spark.createDataFrame([tuple(r[c] for c in v.REQUIRED_COLUMNS) for r in rows], schema)


def silver(spark, *changes):
    return {r["案件編號"]: r for r in layers.silver_table(records(spark, *changes)).collect()}


def test_placeholders_and_malformed_text_become_null(spark):
    rows = layers.cleaned_table(records(
        spark, {"年齡": "NULL", "車齡": ""}, {"年齡": "null", "車齡": "x"}, {"年齡": "3x", "進件日": "20241399"}, {"性別": "  男 "}, {"性別": " "},
    )).orderBy("案件編號").collect()
    assert [r["年齡"] for r in rows] == [None, None, None, 30, 30]
    assert [r["車齡"] for r in rows[:2]] == [None, None]
    assert rows[2]["進件日"] is None and rows[3]["進件日"] == dt.date(2024, 5, 1)
    assert rows[3]["性別"] == "男" and rows[4]["性別"] is None


def test_column_names_are_trimmed_and_the_leak_is_dropped(spark):
    df = records(spark, {}).withColumnRenamed("年齡", " 年齡 ").withColumn(v.LEAK, F.lit("1"))
    cleaned = layers.cleaned_table(df)
    assert "年齡" in cleaned.columns and v.LEAK not in cleaned.columns


def test_latest_record_wins_and_ties_are_decided(spark):
    df = records(
        spark, {"案件編號": "a", "進件日": "20240101"}, {"案件編號": "a", "進件日": "20240301", "原申辦金額": "1"},
        {"案件編號": "a", "進件日": "20240301", "原申辦金額": "9"}, {"案件編號": None}, {"案件編號": "b", "授信結果": " "})
    rows = layers.unique_table(layers.cleaned_table(df)).collect()
    assert [(r["案件編號"], r["原申辦金額"]) for r in rows] == [("a", 9.0)]


def test_deduplication_limits_rows_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = cleaning.latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_pending_outcome_keeps_a_null_label(spark):
    rows = silver(spark, {}, {"授信結果": "WTCD(婉拒)"}, {"授信結果": "PEND(審核中)"})
    assert [rows[str(i)][v.LABEL] for i in range(3)] == [1, 0, None]


def test_education_is_inferred_from_students_only(spark):
    rows = silver(spark, {"教育程度": None, "職業說明": "學生(大專生)"}, {"教育程度": None, "職業說明": "學生(國中生)"},
                  {"教育程度": None}, {"教育程度": "碩士", "職業說明": "學生(大專生)"})
    assert [rows[str(i)]["教育程度"] for i in range(4)] == ["大學", "國中", "Missing", "碩士"]
    assert [rows[str(i)]["教育程度_是否缺失"] for i in range(4)] == [1, 1, 1, 0]
    assert [rows[str(i)]["教育程度_序位"] for i in range(4)] == [5, 2, 0, 6]


def test_car_age_sentinels(spark):
    rows = silver(spark, {"車齡": "-1"}, {"車齡": "-5"}, {"車齡": "101"}, {"車齡": None}, {"車齡": "100"})
    assert [rows[str(i)]["車齡_是否缺失"] for i in range(5)] == [1, 0, 0, 0, 0]
    assert [rows[str(i)]["車齡_異常旗標"] for i in range(5)] == [0, 0, 1, 0, 0]
    assert [rows[str(i)]["車齡_清理後"] for i in range(5)] == [None, None, None, None, 100.0]
    assert rows["0"]["車齡_log"] == 0.0 and rows["0"]["車齡_原始"] == -1.0


def test_counts_and_logs(spark):
    rows = silver(spark, {"內部往來次數": "-1"}, {"內部往來次數": None}, {"原申辦金額": "-1"})
    assert (rows["0"]["內部往來次數_是否特殊值"], rows["0"]["內部往來次數_清理後"]) == (1, 0)
    assert rows["1"]["內部往來次數_清理後"] is None and rows["1"]["內部往來次數_log"] is None
    assert rows["2"]["原申辦金額_log"] is None


@pytest.mark.parametrize("age,band,code", [("20", "~20", 0), ("21", "21-30", 1), ("60", "51-60", 4), ("61", "61~", 5), (None, "61~", 5)])
def test_age_bands(spark, age, band, code):
    row = silver(spark, {"年齡": age})["0"]
    assert (row["年齡組"], row["年齡組_序位"]) == (band, code)


def test_contract_reports_missing_and_extra_columns(spark):
    df = records(spark, {})
    first = layers.bronze_checks(df.drop("年齡")).collect()
    assert [(r["code"], r["severity"]) for r in first] == [("SCH001", "FATAL")]
    rows = layers.bronze_checks(df.withColumn("new", F.lit("1"))).collect()
    assert {r["code"] for r in rows if r["code"]} == {"SCH003", "DQ002", "LB001"}
    assert {r["code"] for r in rows if not r["is_valid"]} == {"DQ002", "LB001"}  # an extra column is only a warning
    assert contract.suite_status(layers.bronze_checks(df)).first()["status"] == "FAIL"


def test_null_is_only_allowed_where_listed(spark):
    df = records(spark, {"性別": None}, {"授信結果": None}, {"性別": "?"})
    found = {(r["column"], r["value"]) for r in contract.unexpected_levels(df, v.ALLOWED_LEVELS).collect()}
    assert found == {("授信結果", None), ("性別", "?")}


def test_empty_label_table(spark):
    row = contract.check_labels(records(spark, {}).limit(0), v.OUTCOME, v.TARGET).first()
    assert (row["code"], row["severity"]) == ("LB002", "FATAL")
