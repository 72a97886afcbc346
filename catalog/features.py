"""Fitted encoders and derived features."""

from __future__ import annotations

import datetime as dt


from catalog.base import APPLICATIONS, R, RAW, applications, query, raw_applications, table, tidy, with_
from catalog.clean import CLEANED, FILLED, SILVER, UNIQUE
from scorewarden import vocabulary as v
from scorewarden.operators import cleaning, encoders, features
from scorewarden.plans import layers
from scorewarden.storage import settled

_BANDS = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "5-LOW": 1}
_NUMBERS = ["amount", "balance"]


def _dev(df):
    return df.where("dev")


_FIT = "fit AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COALESCE(MIN({c}), 0) AS lo, COALESCE(MAX({c}), 1) AS hi FROM applications WHERE dev" for c in _NUMBERS) + ")"


@query("minmax_fit", with_(APPLICATIONS, _FIT, select=f'SELECT "column", lo AS "min", hi AS "max", {R("CASE WHEN hi = lo THEN 1 ELSE hi - lo END")} AS "range" FROM fit'))
def minmax_fit(spark, folder):
    return tidy(encoders.fit_minmax(_dev(applications(spark, folder)), _NUMBERS))


@query("minmax_scale", with_(APPLICATIONS, _FIT, select="SELECT case_id, " + ", ".join(
    R(f"({c} - (SELECT lo FROM fit WHERE \"column\" = '{c}')) / (SELECT hi - lo FROM fit WHERE \"column\" = '{c}')") + f" AS {c}_scaled" for c in _NUMBERS) + " FROM applications"))
def minmax_scale(spark, folder):
    df = applications(spark, folder)
    return tidy(encoders.apply_minmax(df, encoders.fit_minmax(_dev(df), _NUMBERS), _NUMBERS).select("case_id", "amount_scaled", "balance_scaled"))


_FREQ = """freq AS (SELECT 'place' AS "column", place AS value, COUNT(*) / CAST((SELECT COUNT(*) FROM applications WHERE dev) AS DOUBLE) AS freq
    FROM applications WHERE dev AND place IS NOT NULL GROUP BY place
  UNION ALL SELECT 'segment', segment, COUNT(*) / CAST((SELECT COUNT(*) FROM applications WHERE dev) AS DOUBLE)
    FROM applications WHERE dev AND segment IS NOT NULL GROUP BY segment)"""


@query("frequency_fit", with_(APPLICATIONS, _FREQ, select=f"SELECT \"column\", value, {R('freq')} AS freq, 0e0 AS unseen FROM freq"))
def frequency_fit(spark, folder):
    return tidy(encoders.fit_frequency(_dev(applications(spark, folder)), ["place", "segment"]))


def _encoded(spark, folder, unseen: str):
    df = applications(spark, folder)
    fitted = encoders.fit_frequency(_dev(df), ["place", "segment"], unseen)
    return tidy(encoders.apply_frequency(df, fitted, ["place", "segment"], "_freq").select("case_id", "place_freq", "segment_freq"))


def _encoded_sql(default: str) -> str:
    return with_(APPLICATIONS, _FREQ, select=f"""SELECT case_id, {R(f"COALESCE(p.freq, (SELECT {default} FROM freq WHERE \"column\" = 'place'))")} AS place_freq,
      {R(f"COALESCE(s.freq, (SELECT {default} FROM freq WHERE \"column\" = 'segment'))")} AS segment_freq FROM applications
      LEFT JOIN freq p ON p."column" = 'place' AND p.value = place LEFT JOIN freq s ON s."column" = 'segment' AND s.value = segment""")


@query("frequency_encode", _encoded_sql("0 * COUNT(*)"))
def frequency_encode(spark, folder):
    return _encoded(spark, folder, "zero")


@query("frequency_encode_unseen_mean", _encoded_sql("AVG(freq)"))
def frequency_encode_unseen_mean(spark, folder):
    return _encoded(spark, folder, "mean")


@query("frequency_encode_unseen_min", _encoded_sql("MIN(freq)"))
def frequency_encode_unseen_min(spark, folder):
    return _encoded(spark, folder, "min")


@query("ordinal_encode", with_(APPLICATIONS, select="""SELECT case_id, CASE band WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4
  WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 1 ELSE 0 END AS band_code FROM applications"""))
def ordinal_encode(spark, folder):
    return cleaning.encode_ordinal(applications(spark, folder), "band", "band_code", _BANDS).select("case_id", "band_code")


@query("cross_features", with_(APPLICATIONS, select=f"""SELECT case_id, strftime(day, '%Y-%m') AS month,
  {R("amount / CASE band WHEN '1-URGENT' THEN 50000e0 WHEN '2-HIGH' THEN 30000e0 WHEN '5-LOW' THEN 30000e0 ELSE 30000e0 END")} AS burden,
  {R("label * amount")} AS label_amount, {R("COALESCE(label, 0) * balance")} AS label_balance FROM applications"""))
def cross_features(spark, folder):
    df = features.with_month(applications(spark, folder), "day", "month")
    df = features.burden_ratio(df, "amount", "band", {"1-URGENT": 50000.0, "2-HIGH": 30000.0, "5-LOW": -1.0}, 30000.0, "estimate", "burden")
    df = features.products(df, {"label_amount": ("label", "amount")})
    df = features.products(df, {"label_balance": ("label", "balance")}, zero_filled=["label"])
    return tidy(df.select("case_id", "month", "burden", "label_amount", "label_balance"))


_CLASSES = [(["ring", "nut"], "round"), (["red", "blue"], "colour"), (["bolt"], "bolt")]


@query("name_classes", """SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' OR p_name LIKE '%nut%' THEN 'round'
  WHEN p_name LIKE '%red%' OR p_name LIKE '%blue%' THEN 'colour' WHEN p_name LIKE '%bolt%' THEN 'bolt' ELSE 'other' END AS class FROM part""")
def name_classes(spark, folder):
    return features.classify_features(table(spark, folder, "part"), "p_name", _CLASSES, "class").select("p_partkey", "class")


# ---- the whole gold table -----------------------------------------------------------
_OOT = dt.date(2001, 4, 1)
_DEV_TOTAL = "(SELECT COUNT(*) FROM parts WHERE split = 'development')"
_HIGH = v.HIGH_CARDINALITY
PARTS = """parts AS (SELECT *, strftime("進件日", '%Y-%m') AS "進件年月",
  CASE WHEN "進件日" < DATE '2001-04-01' THEN 'development' ELSE 'oot' END AS split FROM silver)"""
ENCODED = "encoded AS (SELECT p.*, " + ", ".join(f'COALESCE(f{i}.freq, 0) AS "{c}_頻率"' for i, c in enumerate(_HIGH)) + """,
  "原申辦金額" / """ + "CASE \"月所得\" " + " ".join(f"WHEN '{k}' THEN {x!r}e0" for k, x in v.INCOME_MIDPOINTS.items()) + """ ELSE 30000e0 END AS "負債月所得比",
  "年齡" * "婚姻狀況_二元" AS "年齡_婚姻交互", COALESCE("車齡_清理後", 0) * "原申辦金額_log" AS "車齡_金額交互",
  "教育程度_序位" * "月所得_序位" AS "教育_所得交互" FROM parts p""" + "".join(
    f""" LEFT JOIN (SELECT "{c}" AS value, COUNT(*) / CAST({_DEV_TOTAL} AS DOUBLE) AS freq FROM parts WHERE split = 'development' GROUP BY 1) f{i} ON p."{c}" = f{i}.value"""
    for i, c in enumerate(_HIGH)) + ")"
_SCALED = layers.scaled_columns(_HIGH)
BOUNDS = "bounds AS (SELECT " + ", ".join(f'MIN("{c}") AS lo{i}, MAX("{c}") AS hi{i}' for i, c in enumerate(_SCALED)) + " FROM encoded WHERE split = 'development')"
GOLD = "gold AS (SELECT \"案件編號\", \"進件日\", \"進件年月\", split, " + ", ".join(
    f'COALESCE(CAST("{c}" AS DOUBLE), 0) AS "{c}"' for c in v.ORDINAL_FEATURES + [b for b in v.BINARY_FEATURES if b != "動產設定"]) + """,
  COALESCE("動產設定", '0') AS "動產設定", "授信結果_二元", """ + ", ".join(
    f'COALESCE(("{c}" - lo{i}) / CAST(CASE WHEN hi{i} = lo{i} THEN 1 ELSE hi{i} - lo{i} END AS DOUBLE), 0) AS "{c}_scaled"' for i, c in enumerate(_SCALED)) + " FROM encoded, bounds)"


def _silver(spark, folder):
    # the gold step reads its input several times; the job reads the written silver table instead
    return settled(layers.silver_table(raw_applications(spark, folder)))


@query("gold_features", with_(RAW, CLEANED, UNIQUE, FILLED, SILVER, PARTS, ENCODED, BOUNDS, GOLD, select="SELECT * EXCLUDE ("
       + ", ".join(f'"{c}_scaled"' for c in _SCALED) + "), " + ", ".join(f'{R(chr(34) + c + "_scaled" + chr(34))} AS "{c}_scaled"' for c in _SCALED) + " FROM gold"))
def gold_features(spark, folder):
    final, _ = layers.gold_table(_silver(spark, folder), _OOT)
    return tidy(final)


@query("fitted_ranges", with_(RAW, CLEANED, UNIQUE, FILLED, SILVER, PARTS, ENCODED, BOUNDS, select=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {R(f'lo{i}')} AS \"min\", {R(f'hi{i}')} AS \"max\", {R(f'CASE WHEN hi{i} = lo{i} THEN 1 ELSE hi{i} - lo{i} END')} AS \"range\" FROM bounds"
    for i, c in enumerate(_SCALED))))
def fitted_ranges(spark, folder):
    _, fitted = layers.gold_table(_silver(spark, folder), _OOT)
    return tidy(fitted["scaler"])


@query("fit_summary", with_(APPLICATIONS, select="""SELECT COUNT(*) AS training_rows, strftime(MIN(day), '%Y-%m-%d') AS period_start,
  strftime(MAX(day), '%Y-%m-%d') AS period_end FROM applications WHERE dev"""))
def fit_summary(spark, folder):
    from catalog.base import day_text
    return day_text(encoders.fit_summary(_dev(applications(spark, folder)), "day"), "period_start", "period_end")


@query("assembled_features", with_(APPLICATIONS, select=f"SELECT case_id, CAST(label AS DOUBLE) AS label, {R('COALESCE(amount, 0)')} AS x0, {R('COALESCE(balance, 0)')} AS x1 FROM applications WHERE label IS NOT NULL"))
def assembled_features(spark, folder):
    from pyspark.ml.functions import vector_to_array
    vector = vector_to_array("features")
    return tidy(features.assembled(applications(spark, folder), _NUMBERS, "label").select(
        "case_id", "label", vector[0].alias("x0"), vector[1].alias("x1")))


