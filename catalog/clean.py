"""Cleaning of raw records and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import RAW, R, query, raw_applications, table, tidy, with_
from scorewarden import vocabulary as v
from scorewarden.operators import cleaning
from scorewarden.plans import layers

_TRIM = 'NULLIF(TRIM("{c}"), \'\')'


def _number(c: str, kind: str) -> str:
    return f'TRY_CAST(CASE WHEN UPPER("{c}") IN (\'NULL\', \'\') THEN NULL ELSE "{c}" END AS {kind})'


def _cleaned_columns() -> list[str]:
    out = []
    for c in v.REQUIRED_COLUMNS:
        if c == v.DAY:
            out.append(f'CAST(TRY_STRPTIME("{c}", \'%Y%m%d\') AS DATE) AS "{c}"')
        elif c in v.INTEGER_COLUMNS:
            out.append(f'{_number(c, "INTEGER")} AS "{c}"')
        elif c in v.DOUBLE_COLUMNS:
            out.append(f'{_number(c, "DOUBLE")} AS "{c}"')
        elif c == "婚姻狀況":
            t = _TRIM.format(c=c)
            out.append(f"CASE WHEN {t} = '同居' THEN '未婚' ELSE {t} END AS \"{c}\"")
        elif c in v.CATEGORY_COLUMNS:
            out.append(f'{_TRIM.format(c=c)} AS "{c}"')
        else:
            out.append(f'"{c}"')
    return out


CLEANED = "cleaned AS (SELECT " + ", ".join(_cleaned_columns()) + " FROM raw)"
UNIQUE = """uniq AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY "案件編號" ORDER BY "進件日" DESC, "原申辦金額" DESC NULLS LAST, "授信結果" DESC) AS rn
  FROM cleaned WHERE "案件編號" IS NOT NULL AND "進件日" IS NOT NULL AND "授信結果" IS NOT NULL) WHERE rn = 1)"""


@query("clean_cast", with_(RAW, CLEANED, select="SELECT * FROM cleaned"))
def clean_cast(spark, folder):
    return layers.cleaned_table(raw_applications(spark, folder))


@query("keyed_rows", with_(RAW, CLEANED, select="""SELECT "授信結果", COUNT(*) AS n FROM cleaned
  WHERE "案件編號" IS NOT NULL AND "進件日" IS NOT NULL AND "授信結果" IS NOT NULL GROUP BY 1"""))
def keyed_rows(spark, folder):
    kept = cleaning.keyed(layers.cleaned_table(raw_applications(spark, folder)), [v.CASE, v.DAY, v.OUTCOME])
    return kept.groupBy(v.OUTCOME).agg(F.count("*").alias("n"))


@query("latest_per_key", """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey
    ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""")
def latest_per_key(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")
    return cleaning.latest_per_key(
        rows, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_extendedprice"]).drop("l_shipdate")


@query("latest_application", with_(RAW, CLEANED, UNIQUE, select="SELECT * FROM uniq"))
def latest_application(spark, folder):
    return layers.unique_table(layers.cleaned_table(raw_applications(spark, folder)))


def _case(c: str, table_: dict, default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {x}" for k, x in table_.items())
    return f"CASE {c} {arms} ELSE {default} END"


_EDU = """CASE WHEN "教育程度" IS NOT NULL THEN "教育程度" WHEN contains("職業說明", '學生(大專生)') THEN '大學'
  WHEN contains("職業說明", '學生(高中職生)') THEN '高中' WHEN contains("職業說明", '學生(國中生)') THEN '國中' ELSE 'Missing' END"""
FILLED = f"""filled AS (SELECT * EXCLUDE ("教育程度", "婚姻狀況", "職業說明", "居住地", "性別", "月所得"),
  {_EDU} AS "教育程度", CASE WHEN "教育程度" IS NULL THEN 1 ELSE 0 END AS "教育程度_是否缺失",
  """ + ", ".join(f"COALESCE(\"{c}\", 'Missing') AS \"{c}\"" for c in ["婚姻狀況", "職業說明", "居住地", "性別", "月所得"]) + """,
  CASE "授信結果" WHEN 'APP(核准)' THEN 1 WHEN 'WTCD(婉拒)' THEN 0 END AS "授信結果_二元",
  "車齡" AS "車齡_原始", CASE WHEN "車齡" = -1 THEN 1 ELSE 0 END AS "車齡_是否缺失",
  CASE WHEN "車齡" > 100 THEN 1 ELSE 0 END AS "車齡_異常旗標",
  CASE WHEN "車齡" < 0 OR "車齡" > 100 THEN NULL ELSE "車齡" END AS "車齡_清理後",
  CASE WHEN "內部往來次數" = -1 THEN 1 ELSE 0 END AS "內部往來次數_是否特殊值",
  CASE WHEN "近半年同業查詢次數" = -1 THEN 1 ELSE 0 END AS "近半年同業查詢次數_是否缺失",
  """ + ", ".join(f'CASE WHEN "{c}" < 0 THEN 0 ELSE "{c}" END AS "{c}_清理後"' for c in ["內部往來次數", "近半年同業查詢次數", "所留市內電話數"]) + """,
  CASE WHEN "年齡" <= 20 THEN '~20' WHEN "年齡" <= 30 THEN '21-30' WHEN "年齡" <= 40 THEN '31-40'
    WHEN "年齡" <= 50 THEN '41-50' WHEN "年齡" <= 60 THEN '51-60' ELSE '61~' END AS "年齡組"
  FROM uniq)"""
SILVER = f"""silver AS (SELECT *,
  CASE WHEN "性別" = '男' THEN 1 ELSE 0 END AS "性別_二元", CASE WHEN "婚姻狀況" = '已婚' THEN 1 ELSE 0 END AS "婚姻狀況_二元",
  {_case('"教育程度"', v.EDUCATION, "0")} AS "教育程度_序位", {_case('"月所得"', v.INCOME_BANDS, "0")} AS "月所得_序位",
  CASE WHEN "月所得" = 'Missing' THEN 1 ELSE 0 END AS "月所得_是否缺失",
  {_case('"年齡組"', v.AGE_ORDINALS, "0")} AS "年齡組_序位",
  LN(1 + "原申辦金額") AS "原申辦金額_log", LN(1 + COALESCE("車齡_清理後", 0)) AS "車齡_log",
  LN(1e0 + "內部往來次數_清理後") AS "內部往來次數_log", LN(1e0 + "近半年同業查詢次數_清理後") AS "近半年同業查詢次數_log",
  LN(1e0 + "所留市內電話數_清理後") AS "所留市內電話數_log"
  FROM filled)"""
_LOGS = ["原申辦金額_log", "車齡_log", "內部往來次數_log", "近半年同業查詢次數_log", "所留市內電話數_log"]


@query("silver_applications", with_(RAW, CLEANED, UNIQUE, FILLED, SILVER, select=f"SELECT * EXCLUDE ({', '.join(_LOGS)}), "
       + ", ".join(f"{R(c)} AS {c}" for c in _LOGS) + " FROM silver"))
def silver_applications(spark, folder):
    return tidy(layers.silver_table(raw_applications(spark, folder)).drop("silver_process_timestamp"))
