"""Models and baselines as append-only tables; the present state is an aggregate of the history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewarden.operators.cleaning import latest_per_key
from scorewarden.operators.metrics import gini
from scorewarden.storage import settled


def current_records(history: DataFrame, key: str = "model_version", at: str = "created_at", tie: Sequence[str] = ()) -> DataFrame:
    """Latest row per key, which is how an append-only table is updated."""
    return latest_per_key(history, [key], [at, *tie])


def active(events: DataFrame, name: str = "baseline_name", at: str = "activated_at") -> DataFrame:
    """One row: the name activated last."""
    return events.agg(F.max_by(name, F.struct(at, name)).alias("active_baseline"), F.max(at).alias("activated_at"))


def baselines(records: DataFrame, events: DataFrame, name: str = "baseline_name", at: str = "activated_at") -> DataFrame:
    """Every recorded baseline with its last activation and whether it is the active one."""
    last = events.groupBy(name).agg(F.max(at).alias(at))
    newest = events.agg(F.max(F.struct(at, name))[name].alias("n")).scalar()
    return records.join(last, name, "left").withColumn("is_active", F.coalesce(F.col(name) == newest, F.lit(False)))


def resolved_baseline(records: DataFrame, events: DataFrame, name: str = "baseline_name", at: str = "activated_at", created: str = "created_at") -> DataFrame:
    """One row: the baseline to use and where it comes from.

    The one activated last, if it is on record; else, as after a lost pointer, the newest on record; a first baseline
    is active without being activated.
    """
    chosen = events.join(records.select(name).distinct(), name, "left_semi").agg(F.max(F.struct(at, name))[name].alias("n")).scalar()
    pointed = events.agg(F.max(F.struct(at, name))[name].alias("n")).scalar()
    found = records.agg(F.max(F.struct(created, name))[name].alias("newest"), F.count("*").alias("n"))
    return found.select(
        F.when(chosen == pointed, chosen).otherwise(F.col("newest")).alias("baseline_name"),
        F.when(chosen == pointed, "activated").when(F.col("n") == 0, "none").when(F.col("n") == 1, "first").otherwise("recovered").alias("source"))


def run_record(spark: SparkSession, run_id: str, mode: str, parameters: Mapping[str, object], outputs: Mapping[str, str]) -> DataFrame:
    """One row that says what a run was started with and where its results are; written next to them."""
    row = (run_id, mode, {k: str(v) for k, v in parameters.items()}, dict(outputs))
    return spark.createDataFrame([row], "run_id string, mode string, parameters map<string,string>, outputs map<string,string>").withColumns({
        "parameter_key": F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries("parameters")))), 256), "recorded_at": F.current_timestamp()})


def next_version(names: DataFrame, column: str, prefix: str = "baseline_v") -> DataFrame:
    """One row: the first unused name of the form prefix + number."""
    used = F.max(F.regexp_extract(F.col(column), f"^{prefix}(\\d+)$", 1).try_cast("int"))
    return names.agg(F.concat(F.lit(prefix), (F.coalesce(used, F.lit(0)) + 1).cast("string")).alias("next_name"))


def mark_exclusive(df: DataFrame, chosen: Column, flag_name: str) -> DataFrame:
    """Set a flag on the chosen row and clear it on all others."""
    return df.withColumn(flag_name, F.coalesce(chosen, F.lit(False)))


def best_version(df: DataFrame, metric: str, key: str = "model_version", order: str | None = None) -> DataFrame:
    """One row: the record with the largest metric; nulls are skipped, the first registered wins ties."""
    known = df.where(F.col(metric).isNotNull())
    first = F.col(order or key)
    # largest metric, then smallest order: max of the metric, then min over its rows
    top = known.agg(F.max(metric).alias("m")).scalar()
    return known.where(F.col(metric) == top).agg(
        F.min_by(key, first).alias("best_version"), F.max(metric).alias("best_value"))


def auto_select_best(df: DataFrame, metric: str, key: str = "model_version", order: str | None = None) -> DataFrame:
    best = best_version(df, metric, key, order).select("best_version").scalar()
    return mark_exclusive(df, F.col(key) == best, "is_best")


def latest_version(df: DataFrame, key: str = "model_version") -> DataFrame:
    return df.agg(F.max(key).alias("latest_version"))


def ranked_records(df: DataFrame, auc: str = "auc_test", key: str = "model_version") -> DataFrame:
    """Records with their Gini and their place, newest name first, names being unique.

    Ranges of names are numbered on their own and shifted by the rows before them, so that no task ranks all records.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(parts, F.desc(key)).sortWithinPartitions(F.desc(key)).withColumn("_at", F.monotonically_increasing_id())
    rows = settled(rows.withColumn("gini", gini(F.col(auc))).withColumn("_part", F.shiftright("_at", 33)))
    before = rows.groupBy("_part").count().selectExpr(
        "_part", "coalesce(sum(count) over (order by _part rows between unbounded preceding and 1 preceding), 0) as _before")
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    # one row per range
    return rows.join(F.broadcast(before), "_part").withColumn("place", place.cast("int")).drop("_part", "_at", "_before")


def zones_wide(zones: DataFrame, by: Sequence[str], names: dict[int, str]) -> DataFrame:
    """Zone summary rows pivoted to one row per model, ready to be joined to its record."""
    columns = [f(F.when(F.col("zone") == code, F.col(source))).alias(f"zone_{names[code]}_{out}")
               for code in names for f, source, out in ((F.max, "count", "count"), (F.max, "actual_approve_rate", "approve_rate"))]
    return zones.groupBy(*by).agg(*columns)


def first_known(sources: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """One row: per column, the first one-row source that has a value."""
    rows = [s.select(F.struct(*columns).alias("r")).limit(1).scalar() for s in sources]
    return sources[0].sparkSession.range(1).select(*(F.coalesce(*(r[c] for r in rows)).alias(c) for c in columns))


def baseline_record(
    run_id: str, name: str, *, holdout: DataFrame, policy: DataFrame, diagnostics: DataFrame, champion: DataFrame
) -> DataFrame:
    """One row that gathers a run's result tables, found by equality of the run id, numbers to 4 places."""
    def pick(df: DataFrame, prefix: str) -> tuple[Column, list[tuple[str, str]]]:
        rest = [(c, t) for c, t in df.dtypes if c != "run_id"]
        return df.where(F.col("run_id") == run_id).select(F.struct(*(c for c, _ in rest)).alias("r")).limit(1).scalar(), rest
    columns = [F.lit(name).alias("baseline_name"), F.lit(run_id).alias("run_id")]
    for prefix, df in (("holdout", holdout), ("policy", policy), ("diagnostics", diagnostics), ("champion", champion)):
        row, rest = pick(df, prefix)
        columns += [(F.round(row[c], 4) if t in ("double", "float") else row[c]).alias(f"{prefix}_{c}") for c, t in rest]
    return holdout.sparkSession.range(1).select(*columns, F.current_timestamp().alias("created_at"))
