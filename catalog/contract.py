"""Contract checks on the raw and encoded applications."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import APPLICATIONS, R, RAW, RAW_COLUMNS, SCORED, applications, query, raw_applications, scored, tidy, with_
from catalog.clean import CLEANED, FILLED, SILVER, UNIQUE
from scorewarden import vocabulary as v
from scorewarden.operators import contract, drift
from scorewarden.plans import layers

_VERDICT = ["check", "column", "code", "severity", "is_valid"]


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


_NULLS = "null_counts AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT(\"{c}\") AS null_count, COUNT(*) AS n, {v.NULL_RATIO_LIMITS.get(c, v.NULL_RATIO_DEFAULT)}e0 AS lim FROM raw"
    for c in RAW_COLUMNS) + ")"


@query("null_ratios", with_(RAW, _NULLS, select=f'SELECT "column", null_count, {R("null_count / CAST(n AS DOUBLE)")} AS null_ratio FROM null_counts'))
def null_ratios(spark, folder):
    return tidy(contract.null_ratios(raw_applications(spark, folder)))


def _check_sql(check: str, column: str, ok: str, code: str, severity: str) -> str:
    return (f"SELECT '{check}' AS \"check\", {column} AS \"column\", CASE WHEN NOT ({ok}) THEN '{code}' END AS code,"
            f" CASE WHEN {ok} THEN 'INFO' ELSE '{severity}' END AS severity, {'TRUE' if severity == 'WARNING' else f'({ok})'} AS is_valid")


_NULL_CHECK = _check_sql("null_ratio", '"column"', "NOT (null_count / CAST(n AS DOUBLE) > lim)", "DQ001", "ERROR") + " FROM null_counts"


@query("null_ratio_checks", with_(RAW, _NULLS, select=_NULL_CHECK))
def null_ratio_checks(spark, folder):
    return contract.check_null_ratios(raw_applications(spark, folder), v.NULL_RATIO_LIMITS, v.NULL_RATIO_DEFAULT).select(_VERDICT)


_LEVELS = "seen AS (" + " UNION ALL ".join(
    f'SELECT \'{c}\' AS "column", "{c}" AS value, COUNT(*) AS n FROM raw GROUP BY 2' for c in v.ALLOWED_LEVELS) + """),
allowed AS (SELECT * FROM (VALUES """ + _values([(c, x) for c, xs in v.ALLOWED_LEVELS.items() for x in xs]) + """) t("column", value)),
unexpected AS (SELECT s.* FROM seen s WHERE NOT EXISTS (
  SELECT 1 FROM allowed a WHERE a."column" = s."column" AND a.value IS NOT DISTINCT FROM s.value))"""


@query("unexpected_levels", with_(RAW, _LEVELS, select='SELECT "column", value, n FROM unexpected'))
def unexpected_levels(spark, folder):
    return contract.unexpected_levels(raw_applications(spark, folder), v.ALLOWED_LEVELS)


_LEVEL_CHECK = _check_sql("allowed_levels", 'c."column"', "COUNT(u.n) = 0", "DQ003", "WARNING") + (
    ' FROM (SELECT DISTINCT "column" FROM allowed) c LEFT JOIN unexpected u ON c."column" = u."column" GROUP BY c."column"')


@query("level_checks", with_(RAW, _LEVELS, select=_LEVEL_CHECK))
def level_checks(spark, folder):
    return contract.check_levels(raw_applications(spark, folder), v.ALLOWED_LEVELS).select(_VERDICT)


@query("range_checks", with_(RAW, CLEANED, select=" UNION ALL ".join(
    _check_sql("numeric_range", f"'{c}'", f'NOT (COALESCE(MIN("{c}") < {lo}, FALSE) OR COALESCE(MAX("{c}") > {hi}, FALSE))', "DQ004", "WARNING")
    + " FROM cleaned" for c, (lo, hi) in v.NUMERIC_RANGES.items())))
def range_checks(spark, folder):
    return contract.check_ranges(layers.cleaned_table(raw_applications(spark, folder)), v.NUMERIC_RANGES).select(_VERDICT)


_LABELS = """labels_seen AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE "授信結果" = 'APP(核准)') AS positive,
  COUNT(*) FILTER (WHERE "授信結果" IS NOT NULL AND "授信結果" NOT IN ('APP(核准)', 'WTCD(婉拒)')) AS other FROM cleaned)"""


@query("label_distribution", with_(RAW, CLEANED, _LABELS, select=f"""SELECT n, positive, other,
  {R("positive / CAST(n AS DOUBLE)")} AS positive_ratio, {R("other / CAST(n AS DOUBLE)")} AS other_ratio FROM labels_seen"""))
def label_distribution(spark, folder):
    return tidy(contract.label_counts(layers.cleaned_table(raw_applications(spark, folder)), v.OUTCOME, v.TARGET))


@query("label_check", with_(RAW, CLEANED, _LABELS, select="""SELECT 'labels' AS "check", '授信結果' AS "column",
  CASE WHEN n = 0 THEN 'LB002' WHEN positive < 0.05e0 * n OR positive > 0.95e0 * n THEN 'LB001' WHEN other > 0.05e0 * n THEN 'LB003' END AS code,
  CASE WHEN n = 0 THEN 'FATAL' WHEN positive < 0.05e0 * n OR positive > 0.95e0 * n THEN 'ERROR' WHEN other > 0.05e0 * n THEN 'WARNING' ELSE 'INFO' END AS severity,
  n > 0 AND positive BETWEEN 0.05e0 * n AND 0.95e0 * n AS is_valid FROM labels_seen"""))
def label_check(spark, folder):
    return contract.check_labels(layers.cleaned_table(raw_applications(spark, folder)), v.OUTCOME, v.TARGET).select(_VERDICT)


@query("row_count_check", with_(RAW, select=_check_sql("row_count", "CAST(NULL AS VARCHAR)", "COUNT(*) >= 1000", "DQ002", "ERROR") + " FROM raw"))
def row_count_check(spark, folder):
    return contract.check_row_count(raw_applications(spark, folder), v.MIN_TOTAL_ROWS).select(_VERDICT)


@query("bronze_checks", with_(RAW, _NULLS, _LEVELS, """raw_labels AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE "授信結果" = 'APP(核准)') AS positive FROM raw)""", select=f"""
  {_check_sql("required_columns", "CAST(NULL AS VARCHAR)", "TRUE", "SCH001", "FATAL")}
  UNION ALL {_check_sql("unexpected_columns", "CAST(NULL AS VARCHAR)", "TRUE", "SCH003", "WARNING")}
  UNION ALL {_check_sql("row_count", "CAST(NULL AS VARCHAR)", "COUNT(*) >= 1000", "DQ002", "ERROR")} FROM raw
  UNION ALL {_NULL_CHECK} UNION ALL {_LEVEL_CHECK}
  UNION ALL SELECT 'labels', '授信結果', 'LB001', 'ERROR', FALSE FROM raw_labels WHERE positive < 0.05e0 * n"""))
def bronze_checks(spark, folder):
    # raw outcomes are still padded, so none counts as positive: the suite must say so
    return layers.bronze_checks(raw_applications(spark, folder)).select(_VERDICT)


@query("suite_status", with_(RAW, _NULLS, _LEVELS, "checks AS (" + _NULL_CHECK + " UNION ALL " + _LEVEL_CHECK + """
  UNION ALL SELECT 'row_count', NULL, NULL, 'INFO', TRUE UNION ALL SELECT 'required_columns', NULL, NULL, 'INFO', TRUE
  UNION ALL SELECT 'unexpected_columns', NULL, NULL, 'INFO', TRUE UNION ALL SELECT 'labels', NULL, 'LB001', 'ERROR', FALSE)""",
  select="""SELECT CASE WHEN COUNT(*) FILTER (WHERE severity IN ('ERROR', 'FATAL')) > 0 THEN 'FAIL'
      WHEN COUNT(*) FILTER (WHERE severity = 'WARNING') > 0 THEN 'WARNING' ELSE 'PASS' END AS status,
    COUNT(*) FILTER (WHERE severity = 'FATAL') AS fatal_count, COUNT(*) FILTER (WHERE severity = 'ERROR') AS error_count,
    COUNT(*) FILTER (WHERE severity = 'WARNING') AS warning_count, COUNT(*) FILTER (WHERE severity = 'INFO') AS info_count FROM checks"""))
def suite_status(spark, folder):
    return contract.suite_status(layers.bronze_checks(raw_applications(spark, folder)))


@query("silver_checks", with_(RAW, CLEANED, UNIQUE, FILLED, SILVER, select=f"""
  {_check_sql("row_count", "CAST(NULL AS VARCHAR)", "COUNT(*) >= 1000", "DQ002", "ERROR")} FROM silver
  UNION ALL {_check_sql("encoded_columns", "CAST(NULL AS VARCHAR)", "TRUE", "SLV001", "ERROR")}
  UNION ALL {_check_sql("label_values", "'授信結果_二元'", 'COUNT(*) FILTER (WHERE "授信結果_二元" NOT IN (0, 1)) = 0', "SLV002", "ERROR")} FROM silver"""))
def silver_checks(spark, folder):
    return layers.silver_checks(layers.silver_table(raw_applications(spark, folder))).select(_VERDICT)


@query("gold_checks", with_(APPLICATIONS, select=f"""
  {_check_sql("development_rows", "CAST(NULL AS VARCHAR)", "COUNT(*) FILTER (WHERE dev) > 0", "GLD001", "FATAL")} FROM applications
  UNION ALL {_check_sql("oot_rows", "CAST(NULL AS VARCHAR)", "COUNT(*) FILTER (WHERE NOT dev) > 0", "GLD002", "WARNING")} FROM applications
  UNION ALL {_check_sql("feature_nulls", "'amount'", "COUNT(*) FILTER (WHERE dev AND amount IS NULL) = 0", "GLD003", "ERROR")} FROM applications
  UNION ALL {_check_sql("feature_nulls", "'label'", "COUNT(*) FILTER (WHERE dev AND label IS NULL) = 0", "GLD003", "ERROR")} FROM applications"""))
def gold_checks(spark, folder):
    parts = applications(spark, folder).withColumn("split", F.when(F.col("dev"), "development").otherwise("oot"))
    return contract.gold_suite(parts, split="split", features=["amount", "label"]).select(_VERDICT)


@query("column_types", "SELECT 'column_types' AS \"check\", c AS \"column\", CASE WHEN ok THEN NULL ELSE 'SCH002' END AS code,"
       " CASE WHEN ok THEN 'INFO' ELSE 'ERROR' END AS severity, ok AS is_valid, COUNT(*) AS rows FROM orders, (VALUES "
       "('o_orderkey', TRUE), ('o_orderdate', TRUE), ('o_totalprice', TRUE), ('o_orderstatus', FALSE)) t(c, ok) GROUP BY ALL")
def column_types(spark, folder):
    from catalog.base import table
    orders = table(spark, folder, "orders")
    declared = {"o_orderkey": "integer", "o_orderdate": "date", "o_totalprice": "double", "o_orderstatus": "double"}
    rows = orders.agg(F.count("*")).scalar()
    return contract.column_types(orders, declared).select(*_VERDICT, rows.alias("rows"))


@query("duplicate_ratio", f"""SELECT COUNT(*) AS n, COUNT(DISTINCT (l_orderkey, l_linenumber)) AS keys,
  {R("(COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber))) / CAST(COUNT(*) AS DOUBLE)")} AS duplicate_ratio FROM lineitem""")
def duplicate_ratio(spark, folder):
    return tidy(contract.duplicate_ratio(scored(spark, folder), ["l_orderkey", "l_linenumber"]))


@query("monthly_rows", with_(APPLICATIONS, select="""SELECT strftime(day, '%Y-%m') AS month, COUNT(*) AS n, COUNT(*) >= 180 AS enough
  FROM applications GROUP BY 1"""))
def monthly_rows(spark, folder):
    return contract.monthly_rows(applications(spark, folder), "day", 180)


@query("label_drift_by_month", with_(APPLICATIONS, select=f"""SELECT month, n, {R("positive_ratio")} AS positive_ratio, {R("change")} AS change,
  COALESCE(ABS(change) <= 0.10e0, TRUE) AS within_limit FROM (SELECT *, positive_ratio - LAG(positive_ratio) OVER (ORDER BY month) AS change
  FROM (SELECT strftime(day, '%Y-%m') AS month, COUNT(*) AS n, AVG(label) AS positive_ratio FROM applications WHERE label IS NOT NULL GROUP BY 1))"""))
def label_drift_by_month(spark, folder):
    return tidy(contract.label_drift_by_month(applications(spark, folder), "day", "label", v.MAX_LABEL_DRIFT))


@query("top_level_share", with_(APPLICATIONS, """seen AS (SELECT 'segment' AS "column", segment AS value, COUNT(*) AS n FROM applications GROUP BY 2
  UNION ALL SELECT 'place', place, COUNT(*) FROM applications GROUP BY 2)""", select=f"""
  SELECT "column", value AS top_value, {R("n / CAST(total AS DOUBLE)")} AS top_ratio, n <= 0.95e0 * total AS within_limit FROM (
    SELECT *, SUM(n) OVER (PARTITION BY "column") AS total,
      ROW_NUMBER() OVER (PARTITION BY "column" ORDER BY n DESC, COALESCE(value, '')) AS rn FROM seen) WHERE rn = 1"""))
def top_level_share(spark, folder):
    return tidy(contract.top_level_share(applications(spark, folder), ["segment", "place"]))


@query("score_range_profile", with_(SCORED, select=f"""SELECT 'score' AS "column", {R("MIN(score)")} AS low, {R("MAX(score)")} AS high, COUNT(*) AS n FROM scored"""))
def score_range_profile(spark, folder):
    rows = contract.profile(scored(spark, folder), ranges=["score"])
    return tidy(rows.select(F.lit("score").alias("column"), F.col("lows")["score"].alias("low"), F.col("highs")["score"].alias("high"), "n"))


@query("schema_checks", f"""{_check_sql("required_columns", "CAST(NULL AS VARCHAR)", "FALSE", "SCH001", "FATAL").replace(" AS is_valid", " AS is_valid, COUNT(*) AS rows")} FROM orders
  UNION ALL {_check_sql("unexpected_columns", "CAST(NULL AS VARCHAR)", "FALSE", "SCH003", "WARNING")}, COUNT(*) FROM orders
  UNION ALL {_check_sql("column_types", "'o_orderkey'", "FALSE", "SCH002", "ERROR")}, COUNT(*) FROM orders
  UNION ALL {_check_sql("column_types", "'o_totalprice'", "TRUE", "SCH002", "ERROR")}, COUNT(*) FROM orders""")
def schema_checks(spark, folder):
    """A table that lacks a required column, has an undeclared one and a mistyped one."""
    from catalog.base import table
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").cast("string"), "o_totalprice", "o_custkey")
    declared = {"o_orderkey": "integer", "o_totalprice": "double", "o_orderdate": "date"}
    rows = orders.agg(F.count("*")).scalar()
    checks = contract.required_columns(orders, list(declared)).unionByName(contract.unexpected_columns(orders, list(declared))).unionByName(
        contract.column_types(orders, declared))
    return checks.select(*_VERDICT, rows.alias("rows"))


@query("limit_checks", with_(APPLICATIONS, """months AS (SELECT strftime(day, '%Y-%m') AS month, COUNT(*) AS n, AVG(label) AS p FROM applications GROUP BY 1),
labelled AS (SELECT strftime(day, '%Y-%m') AS month, AVG(label) AS p FROM applications WHERE label IS NOT NULL GROUP BY 1),
jumps AS (SELECT ABS(p - LAG(p) OVER (ORDER BY month)) AS c FROM labelled),
tops AS (SELECT MAX(n) / CAST(SUM(n) AS DOUBLE) AS share FROM (SELECT segment, COUNT(*) AS n FROM applications GROUP BY 1)),
known AS (SELECT DISTINCT place FROM applications WHERE dev AND place IS NOT NULL),
late AS (SELECT COUNT(*) FILTER (WHERE place IS NOT NULL AND place NOT IN (SELECT place FROM known)) / CAST(COUNT(*) AS DOUBLE) AS share FROM applications WHERE NOT dev)""", select=f"""
  {_check_sql("duplicates", "'day'", "(COUNT(*) - COUNT(DISTINCT day)) / CAST(COUNT(*) AS DOUBLE) <= 0.01e0", "DQ001", "WARNING")} FROM applications
  UNION ALL {_check_sql("monthly_rows", "'day'", "COUNT(*) FILTER (WHERE n < 180) = 0", "DQ002", "WARNING")} FROM months
  UNION ALL {_check_sql("top_level", "'segment'", "share <= 0.15e0", "DR001", "WARNING")} FROM tops
  UNION ALL {_check_sql("label_drift", "'label'", "COUNT(*) FILTER (WHERE c > 0.02e0) = 0", "DR001", "WARNING")} FROM jumps
  UNION ALL {_check_sql("unseen_levels", "'place'", "share <= 0.05e0", "DR002", "WARNING")} FROM late"""))
def limit_checks(spark, folder):
    """Limits of keys, months, values, label drift and unseen values as check rows."""
    rows = applications(spark, folder)
    return (
        contract.check_duplicates(rows, ["day"], 0.01).unionByName(contract.check_monthly_rows(rows, "day", 180))
        .unionByName(contract.check_top_levels(rows, ["segment"], 0.15)).unionByName(contract.check_label_drift(rows, "day", "label", 0.02))
        .unionByName(contract.check_unseen(drift.unseen_summary(rows, ["place"], "dev"), 0.05))).select(_VERDICT)
