"""Registration, shared views, and SQL building blocks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

DATA_START, CUT, TODAY = dt.date(1995, 1, 1), dt.date(2000, 1, 1), dt.date(2002, 1, 15)
LOWER, UPPER = 0.5, 0.85


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show."""
    return df.select(*(F.round(c, places).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))


def day_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


# ---- SQL pieces -----------------------------------------------------------------
def R(expr: str, places: int = 6) -> str:  # noqa: N802
    return f"(ROUND(CAST({expr} AS DOUBLE), {places}) + 0)"


def N(expr: str) -> str:  # noqa: N802
    return f"CAST({expr} AS BIGINT)"


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def pick(index: str, values: Sequence[str | None]) -> str:
    """CASE that is valid in both engines."""
    arms = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values))
    return f"CASE ({index}) % {len(values)} {arms} END"


def spark_days(df: DataFrame, **days: str) -> DataFrame:
    return df.withColumns({out: F.col(c).cast("date") for out, c in days.items()})


# ---- applications: orders with customer and nation ----------------------------------
APPLICATIONS = """applications AS (
  SELECT o_orderkey AS case_id, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS outcome,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS label,
         o_totalprice AS amount, o_orderpriority AS band, c_mktsegment AS segment, n_name AS nation,
         c_acctbal AS balance,
         CASE WHEN CAST(o_orderdate AS DATE) >= DATE '2000-07-01' AND o_orderkey % 10 = 0 THEN 'NEW_' || n_name
              WHEN o_orderkey % 29 = 0 THEN NULL ELSE n_name END AS place,
         CAST(o_orderdate AS DATE) < DATE '2000-01-01' AS dev
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"""


def applications(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer, nation = (table(spark, folder, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").join(
        nation, customer.c_nationkey == nation.n_nationkey, "left")
    day = F.col("o_orderdate").cast("date")
    return joined.select(
        F.col("o_orderkey").alias("case_id"), day.alias("day"), F.col("o_orderstatus").alias("outcome"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0).alias("label"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("band"),
        F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"), F.col("c_acctbal").alias("balance"),
        F.when((day >= F.lit(dt.date(2000, 7, 1))) & (F.col("o_orderkey") % 10 == 0), F.concat(F.lit("NEW_"), "n_name"))
        .when(F.col("o_orderkey") % 29 == 0, None).otherwise(F.col("n_name")).alias("place"),
        (day < F.lit(CUT)).alias("dev"))


# ---- raw application records in the declared contract --------------------------------
_EDUCATION = ["國中", "高中", "專科", "大學", "碩士", None, "博士以上", "其他", "研究所"]
_INCOME = ["~20,000", "20,000~24,999", "35,000~39,999", "60,000~69,999", "80,000~", None, "unknown", "50,000~54,999"]
# (name, expression valid in both engines); {day} is the date as yyyyMMdd text
_RAW = [
    ("案件編號", "CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR(20)) END"),
    ("進件日", "CASE WHEN o_orderkey % 97 = 0 THEN 'not a day' ELSE {day} END"),
    ("授信結果", "CASE o_orderstatus WHEN 'F' THEN ' APP(核准)' WHEN 'O' THEN 'WTCD(婉拒) ' ELSE 'PEND(審核中)' END"),
    ("年齡", "CASE WHEN o_orderkey % 19 = 0 THEN 'NULL' ELSE CAST(18 + o_orderkey % 60 AS VARCHAR(20)) END"),
    ("性別", "CASE WHEN o_orderkey % 23 = 0 THEN '' WHEN o_custkey % 2 = 0 THEN '男' ELSE '女' END"),
    ("教育程度", pick("o_orderkey", _EDUCATION)),
    ("婚姻狀況", pick("o_custkey", ["已婚", "未婚", " 離婚", "同居"])),
    ("月所得", pick("o_orderkey", _INCOME)),
    ("職業說明", "CASE WHEN o_orderkey % 7 = 0 THEN '學生(大專生)' WHEN o_orderkey % 11 = 0 THEN '學生(國中生)' ELSE c_mktsegment END"),
    ("居住地", "CASE WHEN o_orderkey % 31 = 0 THEN ' ' ELSE n_name END"),
    ("廠牌車型", "CONCAT('Brand#', CAST(o_custkey % 25 AS VARCHAR(20)))"),
    ("原申辦金額", "CASE WHEN o_orderkey % 37 = 0 THEN 'null' ELSE CAST(o_totalprice AS VARCHAR(40)) END"),
    ("申辦期數", "CAST(12 + o_orderkey % 48 AS VARCHAR(20))"),
    ("車齡", "CASE WHEN o_orderkey % 11 = 0 THEN '-1' WHEN o_orderkey % 13 = 0 THEN '150' WHEN o_orderkey % 17 = 0 THEN ''"
     " WHEN o_orderkey % 41 = 0 THEN '-5' ELSE CAST(o_orderkey % 20 AS VARCHAR(20)) END"),
    ("動產設定", pick("o_orderkey", ["Y", "N", None])),
    ("內部往來次數", "CASE WHEN o_orderkey % 43 = 0 THEN 'oops' ELSE CAST(o_orderkey % 7 - 1 AS VARCHAR(20)) END"),
    ("近半年同業查詢次數", "CAST(o_custkey % 5 - 1 AS VARCHAR(20))"),
    ("所留市內電話數", "CAST(o_orderkey % 3 AS VARCHAR(20))"),
]
RAW_COLUMNS = [c for c, _ in _RAW]
RAW = "raw AS (\n  SELECT " + ",\n    ".join(
    f'{e.format(day="strftime(o_orderdate, " + chr(39) + "%Y%m%d" + chr(39) + ")")} AS "{c}"' for c, e in _RAW
) + "\n  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"


def raw_applications(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer, nation = (table(spark, folder, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").join(
        nation, customer.c_nationkey == nation.n_nationkey, "left")
    return joined.selectExpr(*(f"cast({e.format(day='date_format(o_orderdate, ' + repr('yyyyMMdd') + ')')} as string) as `{c}`" for c, e in _RAW))


# ---- scored: line items with two scores, one with many ties ---------------------------
SCORED = """scored AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS day,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS label,
         CASE WHEN l_orderkey % 5 = 0 THEN NULL WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS late_label,
         l_extendedprice / 105000e0 AS score, l_quantity / 50e0 AS coarse,
         l_returnflag AS segment, l_discount AS discount, l_tax AS tax, l_quantity AS quantity
  FROM lineitem)"""


def scored(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("l_linestatus") == "F", 1).otherwise(0)
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("day"), label.alias("label"),
        F.when(F.col("l_orderkey") % 5 == 0, None).otherwise(label).alias("late_label"),
        (F.col("l_extendedprice") / 105000.0).alias("score"), (F.col("l_quantity") / 50.0).alias("coarse"),
        F.col("l_returnflag").alias("segment"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
        F.col("l_quantity").alias("quantity"))


MODELS = ["boosted", "forest", "linear"]
MODEL_SCORES = """model_scores AS (
  SELECT 'boosted' AS model, day, label, segment, score * 0.3e0 + label * 0.7e0 AS p FROM scored
  UNION ALL SELECT 'forest', day, label, segment, (score * 0.5e0 + coarse * 0.2e0) + label * 0.3e0 FROM scored
  UNION ALL SELECT 'linear', day, label, segment, coarse FROM scored)"""


def model_scores(spark: SparkSession, folder: str, rows: DataFrame | None = None, ids: Sequence[str] = ()) -> DataFrame:
    """Three score columns of the same rows in long form; one scan. ``ids`` are kept beside day, label and segment."""
    rows = scored(spark, folder) if rows is None else rows
    s, c, y = F.col("score"), F.col("coarse"), F.col("label")
    kept = ["day", "label", "segment", *ids]
    return rows.select(
        *kept, (s * 0.3 + y * 0.7).alias("boosted"), (s * 0.5 + c * 0.2 + y * 0.3).alias("forest"), c.alias("linear")
    ).unpivot(kept, MODELS, "model", "p")


# ---- SQL of the metrics, written from ranks instead of running counts ------------------
def metric_ctes(source: str, by: Sequence[str], label: str, score: str, out: str = "metrics") -> list[str]:
    g = ", ".join(by)
    part = f"PARTITION BY {g}" if by else ""
    lead = f"{g}, " if by else ""
    also = f"{g}, " if by else ""
    group = f"GROUP BY {g}" if by else ""
    return [
        f"""{out}_ranked AS (
  SELECT {lead}{label} AS y, {score} AS s,
    RANK() OVER ({part} ORDER BY {score}) + (COUNT(*) OVER (PARTITION BY {also}{score}) - 1) / 2e0 AS r,
    SUM({label}) OVER ({part} ORDER BY {score}) AS pos_up, SUM(1 - {label}) OVER ({part} ORDER BY {score}) AS neg_up,
    SUM({label}) OVER ({part} ORDER BY {score} DESC) AS pos_down, COUNT(*) OVER ({part} ORDER BY {score} DESC) AS all_down,
    SUM({label}) OVER ({part}) AS p, SUM(1 - {label}) OVER ({part}) AS q
  FROM {source} WHERE {label} IS NOT NULL AND {score} IS NOT NULL)""",
        f"""{out}_sums AS (
  SELECT {lead}COUNT(*) AS n, MAX(p) AS p, MAX(q) AS q, SUM(CASE WHEN y = 1 THEN r ELSE 0 END) AS pos_ranks,
    SUM(CASE WHEN y = 1 THEN CAST(pos_down AS DOUBLE) / all_down ELSE 0 END) AS steps,
    MAX(ABS(CAST(pos_up AS DOUBLE) / NULLIF(p, 0) - CAST(neg_up AS DOUBLE) / NULLIF(q, 0))) AS gap,
    AVG((s - y) * (s - y)) AS brier,
    COUNT(*) FILTER (WHERE y = 1 AND s >= 0.5e0) AS tp, COUNT(*) FILTER (WHERE y = 0 AND s >= 0.5e0) AS fp,
    COUNT(*) FILTER (WHERE y = 1 AND s < 0.5e0) AS fn, COUNT(*) FILTER (WHERE y = 0 AND s < 0.5e0) AS tn
  FROM {out}_ranked {group})""",
        f"""{out} AS (
  SELECT {lead}n AS rows,
    CASE WHEN p * q > 0 THEN (pos_ranks - p * (p + 1) / 2e0) / (CAST(p AS DOUBLE) * q) ELSE 0 END AS auc,
    COALESCE(steps / NULLIF(CAST(p AS DOUBLE), 0), 0) AS auc_pr, brier AS brier_score,
    COALESCE(2e0 * tp / NULLIF(2 * tp + fp + fn, 0), 0) AS f1, COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0) AS precision,
    COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0) AS recall,
    COALESCE(2e0 * tn / NULLIF(2 * tn + fp + fn, 0), 0) AS f1_reject,
    COALESCE(CAST(tn AS DOUBLE) / NULLIF(tn + fn, 0), 0) AS precision_reject,
    COALESCE(CAST(tn AS DOUBLE) / NULLIF(tn + fp, 0), 0) AS recall_reject,
    COALESCE(gap, 0) AS ks, tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive,
    CAST(p AS DOUBLE) / n AS positive_ratio
  FROM {out}_sums)""",
    ]


METRIC_DOUBLES = ["auc", "auc_pr", "brier_score", "f1", "precision", "recall", "f1_reject", "precision_reject",
                  "recall_reject", "ks", "positive_ratio"]
METRIC_COUNTS = ["rows", "true_negative", "false_positive", "false_negative", "true_positive"]


def metric_select(by: Sequence[str], source: str = "metrics") -> str:
    parts = [*by, *(f"{R(m)} AS {m}" for m in METRIC_DOUBLES), *(f"{N(m)} AS {m}" for m in METRIC_COUNTS)]
    return f"SELECT {', '.join(parts)} FROM {source}"


WINDOWS = """windows AS (
  SELECT CAST(k + 1 AS INTEGER) AS window_id, CAST(s AS DATE) AS train_start,
    CAST(s + INTERVAL 4 MONTH - INTERVAL 1 DAY AS DATE) AS train_end, CAST(s + INTERVAL 4 MONTH AS DATE) AS monitor_start,
    CAST(s + INTERVAL 6 MONTH - INTERVAL 1 DAY AS DATE) AS monitor_end
  FROM (SELECT k, DATE '1995-01-01' + INTERVAL (2 * k) MONTH AS s FROM range(0, 40) t(k))
  WHERE s + INTERVAL 6 MONTH - INTERVAL 1 DAY < DATE '2000-01-01')"""


def column(name: str) -> Column:
    return F.col(name)
