"""The model registry, played with parts as versions and line items as their history."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import LOWER, MODEL_SCORES, N, R, SCORED, UPPER, day_text, model_scores, query, table, tidy, with_
from catalog.routing import _summary
from scorewarden import vocabulary as v
from scorewarden.operators import registry, routing

_HISTORY = """history AS (SELECT 'part_' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS model_version, l_shipdate AS created_at,
  l_orderkey, l_linenumber, l_discount AS auc_test, l_extendedprice AS price FROM lineitem)""", """current AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY model_version ORDER BY created_at DESC, l_orderkey DESC, l_linenumber DESC, price DESC) AS rn FROM history) WHERE rn = 1)"""


def _history(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("part_"), F.lpad(F.col("l_partkey").cast("string"), 9, "0")).alias("model_version"), F.col("l_shipdate").alias("created_at"),
        "l_orderkey", "l_linenumber", F.col("l_discount").alias("auc_test"), F.col("l_extendedprice").alias("price"))


def _current(spark, folder):
    return registry.current_records(_history(spark, folder), tie=["l_orderkey", "l_linenumber", "price"])


@query("registry_current", with_(*_HISTORY, select="SELECT model_version, l_orderkey, l_linenumber, auc_test FROM current"))
def registry_current(spark, folder):
    return _current(spark, folder).select("model_version", "l_orderkey", "l_linenumber", "auc_test")


@query("registry_best", with_(*_HISTORY, select="SELECT model_version AS best_version, auc_test AS best_value FROM current ORDER BY auc_test DESC, model_version LIMIT 1"))
def registry_best(spark, folder):
    return registry.best_version(_current(spark, folder), "auc_test")


@query("registry_marked", with_(*_HISTORY, select="""SELECT model_version, model_version = (SELECT model_version FROM current ORDER BY price DESC, model_version LIMIT 1) AS is_best FROM current"""))
def registry_marked(spark, folder):
    return registry.auto_select_best(_current(spark, folder), "price").select("model_version", "is_best")


@query("registry_ranked", with_(*_HISTORY, select=f"SELECT model_version, {R('2 * auc_test - 1')} AS gini, CAST(ROW_NUMBER() OVER (ORDER BY model_version DESC) AS INTEGER) AS place FROM current"))
def registry_ranked(spark, folder):
    return tidy(registry.ranked_records(_current(spark, folder)).select("model_version", "gini", "place"))


@query("latest_version", with_(*_HISTORY, select="SELECT MAX(model_version) AS latest_version FROM history"))
def latest_version(spark, folder):
    return registry.latest_version(_history(spark, folder))


@query("active_baseline", with_(*_HISTORY, select="""SELECT model_version AS active_baseline, strftime(created_at, '%Y-%m-%d') AS activated_at
  FROM history ORDER BY created_at DESC, model_version DESC LIMIT 1"""))
def active_baseline(spark, folder):
    return day_text(registry.active(_history(spark, folder), "model_version", "created_at"), "activated_at")


@query("next_version", "SELECT 'Brand#' || CAST(MAX(CAST(substr(p_brand, 7) AS INTEGER)) + 1 AS VARCHAR) AS next_name FROM part")
def next_version(spark, folder):
    return registry.next_version(table(spark, folder, "part"), "p_brand", "Brand#")


@query("registry_zones", with_(SCORED, MODEL_SCORES, _summary("model_scores", "p", "model"), select="SELECT model, " + ", ".join(
    f"{N(f'MAX(count) FILTER (WHERE zone = {c})')} AS zone_{n}_count, {R(f'MAX(actual_approve_rate) FILTER (WHERE zone = {c})')} AS zone_{n}_approve_rate"
    for c, n in ((2, "high"), (1, "manual"), (0, "low"))) + " FROM summary GROUP BY model"))
def registry_zones(spark, folder):
    zones = routing.zone_summary(model_scores(spark, folder), "label", "p", LOWER, UPPER, v.ZONE_NAMES, ["model"])
    return tidy(registry.zones_wide(zones, ["model"], {2: "high", 1: "manual", 0: "low"}))


@query("first_known_metrics", with_(*_HISTORY, select="SELECT MAX(auc_test) AS auc, CAST(NULL AS DOUBLE) AS ks, COUNT(*) AS rows FROM history"))
def first_known_metrics(spark, folder):
    rows = _history(spark, folder)
    nothing = rows.agg(F.lit(None).cast("double").alias("auc"), F.lit(None).cast("double").alias("ks"), F.lit(None).cast("bigint").alias("rows"))
    known = rows.agg(F.max("auc_test").alias("auc"), F.lit(None).cast("double").alias("ks"), F.count("*").alias("rows"))
    return registry.first_known([nothing, known], ["auc", "ks", "rows"])


@query("baseline_record", with_(SCORED, MODEL_SCORES, select=f"""SELECT 'baseline_v1' AS baseline_name, 'boosted' AS run_id, ROUND(AVG(p), 4) + 0 AS holdout_mean, COUNT(*) AS holdout_rows,
  ROUND(AVG(label), 4) + 0 AS policy_rate, {N("COUNT(DISTINCT segment)")} AS diagnostics_segments, strftime(MIN(day), '%Y-%m-%d') AS champion_first FROM model_scores WHERE model = 'boosted'"""))
def baseline_record(spark, folder):
    rows = model_scores(spark, folder).withColumnRenamed("model", "run_id").groupBy("run_id")
    record = registry.baseline_record(
        "boosted", "baseline_v1", holdout=rows.agg(F.avg("p").alias("mean"), F.count("*").alias("rows")), policy=rows.agg(F.avg("label").alias("rate")),
        diagnostics=rows.agg(F.count_distinct("segment").alias("segments")), champion=rows.agg(F.date_format(F.min("day"), "yyyy-MM-dd").alias("first")))
    return record.drop("created_at")


_NAMED = """records AS (SELECT p_brand AS baseline_name, COUNT(*) AS parts, MAX(p_retailprice) AS created_at FROM part GROUP BY 1),
events AS (SELECT p_brand AS baseline_name, CAST(o_orderdate AS DATE) AS activated_at FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def _named(spark, folder):
    part = table(spark, folder, "part")
    records = part.groupBy(F.col("p_brand").alias("baseline_name")).agg(F.count("*").alias("parts"), F.max("p_retailprice").alias("created_at"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    dated = lines.join(table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    events = dated.join(part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("baseline_name")), "l_partkey")
    return records, events.select("baseline_name", F.col("o_orderdate").cast("date").alias("activated_at"))


@query("baselines", f"""WITH {_NAMED} SELECT baseline_name, parts, strftime(last, '%Y-%m-%d') AS activated_at,
  coalesce(baseline_name = (SELECT baseline_name FROM events ORDER BY activated_at DESC, baseline_name DESC LIMIT 1), FALSE) AS is_active
  FROM records LEFT JOIN (SELECT baseline_name, MAX(activated_at) AS last FROM events GROUP BY 1) USING (baseline_name)""")
def baselines(spark, folder):
    records, events = _named(spark, folder)
    return day_text(registry.baselines(records, events), "activated_at").select("baseline_name", "parts", "activated_at", "is_active")


@query("resolved_baseline", f"""WITH {_NAMED}, last AS (SELECT baseline_name FROM events ORDER BY activated_at DESC, baseline_name DESC LIMIT 1),
  newest AS (SELECT baseline_name FROM records WHERE baseline_name <> (SELECT * FROM last) ORDER BY created_at DESC, baseline_name DESC LIMIT 1)
  SELECT 'kept' AS kind, baseline_name, 'activated' AS source FROM last UNION ALL SELECT 'lost', baseline_name, 'recovered' FROM newest
  UNION ALL SELECT 'first', MIN(baseline_name), 'first' FROM records""")
def resolved_baseline(spark, folder):
    """The active baseline, the one after its record was lost, and a first one that nobody activated."""
    records, events = _named(spark, folder)
    last = registry.active(events).select("active_baseline").scalar()
    first = records.where(F.col("baseline_name") == records.agg(F.min("baseline_name")).scalar())
    found = {"kept": (records, events), "lost": (records.where(F.col("baseline_name") != last), events), "first": (first, events.limit(0))}
    rows = [registry.resolved_baseline(*pair).select(F.lit(kind).alias("kind"), "baseline_name", "source") for kind, pair in found.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])
