"""Time splits, rolling windows, folds and retraining periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    APPLICATIONS, CUT, DATA_START, R, SCORED, WINDOWS, applications, day_text, query, scored, tidy, with_,
)
from scorewarden.operators import splits


@query("dev_oot_split", with_(APPLICATIONS, select="""SELECT CASE WHEN day < DATE '2000-01-01' THEN 'development' ELSE 'oot' END AS split,
  COUNT(*) AS n, strftime(MIN(day), '%Y-%m-%d') AS first_day, strftime(MAX(day), '%Y-%m-%d') AS last_day FROM applications GROUP BY 1"""))
def dev_oot_split(spark, folder):
    parts = splits.split_at(applications(spark, folder), "day", CUT)
    return day_text(parts.groupBy("split").agg(
        F.count("*").alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day")), "first_day", "last_day")


@query("rolling_window_stats", with_(APPLICATIONS, WINDOWS, select=f"""
  SELECT window_id, phase, strftime(MIN(a), '%Y-%m-%d') AS starts, strftime(MIN(b), '%Y-%m-%d') AS ends, COUNT(*) AS n, {R("AVG(label)")} AS positive_ratio
  FROM (SELECT window_id, 'train' AS phase, train_start AS a, train_end AS b FROM windows
        UNION ALL SELECT window_id, 'monitor', monitor_start, monitor_end FROM windows) w
  JOIN applications ON day BETWEEN a AND b GROUP BY 1, 2"""))
def rolling_window_stats(spark, folder):
    windows = splits.rolling_windows(spark, DATA_START, CUT)
    tagged = splits.tag_windows(applications(spark, folder), windows, "day").groupBy("window_id", "phase").agg(
        F.count("*").alias("n"), F.avg("label").alias("positive_ratio"))
    train = F.col("phase") == "train"
    dated = tagged.join(F.broadcast(windows), "window_id").withColumns({  # a handful of generated rows
        "starts": F.when(train, F.col("train_start")).otherwise(F.col("monitor_start")),
        "ends": F.when(train, F.col("train_end")).otherwise(F.col("monitor_end"))})
    return tidy(day_text(dated, "starts", "ends").select("window_id", "phase", "starts", "ends", "n", "positive_ratio"))


_FOLDS = """tagged AS (SELECT a.*, window_id FROM applications a JOIN windows ON day BETWEEN train_start AND train_end),
months AS (SELECT *, DENSE_RANK() OVER (PARTITION BY window_id ORDER BY month) AS m FROM (
  SELECT DISTINCT window_id, strftime(day, '%Y-%m') AS month FROM tagged)),
folds AS (SELECT window_id, month, k AS fold, CASE WHEN m <= k + 1 THEN 'train' ELSE 'validate' END AS role FROM months, range(1, 3) t(k)
  WHERE m <= k + 2 AND EXISTS (SELECT 1 FROM months x WHERE x.window_id = months.window_id AND x.m = k + 2))"""


@query("time_cv_folds", with_(APPLICATIONS, WINDOWS, _FOLDS, select="""SELECT t.window_id, CAST(fold AS INTEGER) AS fold, role, COUNT(*) AS n,
  CAST(SUM(case_id) AS BIGINT) AS ids FROM tagged t JOIN folds f ON t.window_id = f.window_id AND strftime(t.day, '%Y-%m') = f.month GROUP BY 1, 2, 3"""))
def time_cv_folds(spark, folder):
    train = splits.tag_windows(applications(spark, folder), splits.rolling_windows(spark, DATA_START, CUT), "day").where("phase = 'train'")
    return splits.month_folds(train, "day", ["window_id"]).groupBy("window_id", "fold", "role").agg(
        F.count("*").alias("n"), F.sum("case_id").alias("ids"))


@query("two_thirds_split", with_(APPLICATIONS, select="""SELECT case_id, CASE WHEN rn <= (2 * n) // 3 THEN 'policy' ELSE 'holdout' END AS split
  FROM (SELECT case_id, ROW_NUMBER() OVER (ORDER BY day, case_id) AS rn, COUNT(*) OVER () AS n FROM applications WHERE NOT dev)"""))
def two_thirds_split(spark, folder):
    return splits.two_thirds_split(applications(spark, folder).where(~F.col("dev")), "day", "case_id").select("case_id", "split")


@query("three_way_split", with_(SCORED, """first AS (SELECT MIN(day) AS d FROM scored)""", select="""
  SELECT CASE WHEN day < d + INTERVAL 18 MONTH THEN 'development' WHEN day < d + INTERVAL 22 MONTH THEN 'policy' ELSE 'holdout' END AS split,
  COUNT(*) AS n, strftime(MAX(day), '%Y-%m-%d') AS last_day FROM scored, first GROUP BY 1"""))
def three_way_split(spark, folder):
    return day_text(splits.three_way_split(scored(spark, folder), "day").groupBy("split").agg(
        F.count("*").alias("n"), F.max("day").alias("last_day")), "last_day")


def _text(**periods: str) -> str:
    return ", ".join(f"strftime(CAST({e} AS DATE), '%Y-%m-%d') AS {c}" for c, e in periods.items())


@query("retraining_periods", with_(APPLICATIONS, "days AS (SELECT DISTINCT day FROM applications)", """s AS (
  SELECT day, CAST(day - INTERVAL 24 MONTH AS DATE) AS a FROM days)""", """t AS (SELECT *, CAST(a + INTERVAL 18 MONTH AS DATE) AS p FROM s)""",
  """u AS (SELECT *, CAST(p + INTERVAL 4 MONTH AS DATE) AS h FROM t)""", select="SELECT " + _text(
      data_start="a", data_end="day", development_start="a", development_end="p - INTERVAL 1 DAY", policy_validation_start="p",
      policy_validation_end="h - INTERVAL 1 DAY", final_holdout_start="h", final_holdout_end="day") + " FROM u"))
def retraining_periods(spark, folder):
    return splits.retraining_periods(applications(spark, folder).select("day").distinct(), "day").drop("day")


@query("two_part_periods", with_(APPLICATIONS, "days AS (SELECT DISTINCT day FROM applications)", """s AS (
  SELECT day, CAST(day - INTERVAL 6 MONTH AS DATE) AS o FROM days)""", """t AS (SELECT *, CAST(o - INTERVAL 1 DAY AS DATE) AS e FROM s)""",
  select="SELECT " + _text(dev_start="CAST(e - INTERVAL 18 MONTH AS DATE) + INTERVAL 1 DAY", dev_end="e", oot_start="o", oot_end="day") + " FROM t"))
def two_part_periods(spark, folder):
    return splits.two_part_periods(applications(spark, folder).select("day").distinct(), "day").drop("day")
