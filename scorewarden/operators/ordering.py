"""Order statistics that never sort a whole table, or a whole group, in one task.

A window without ``partitionBy`` moves every row to one task, and ``percentile``
keeps every distinct value of a group in one buffer. Here the value axis is cut
into about equally heavy buckets first. Equal values always share a bucket, so
each bucket can be sorted alone and the counts of the buckets before it, a table
of groups x buckets rows, supply the offset. Equal values are merged into one
counted row before any shuffle, so neither a hot value nor a hot group ends up
in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewarden.storage import settled, small_side

FEWEST_BUCKETS = 64
EDGE_SAMPLE = 0.05
#: Rows of a bucket that a task holds as arrays.
BUCKET_ROWS = 1 << 20


def bucket_count(df: DataFrame) -> int:
    """One bucket per shuffle task, so that a bucket is about one task's work; the setting follows the data."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(FEWEST_BUCKETS, tasks)


def bucket_edges(df: DataFrame, value: str, buckets: int | None = None) -> list[float]:
    """Fewer than ``buckets`` increasing cut points of about equal weight.

    One pass with a mergeable sketch of a sample. The cut points steer only how
    the work is spread, never the result, so their error does not matter.
    """
    buckets = buckets or bucket_count(df)
    shares = [i / buckets for i in range(1, buckets)]
    if not shares:
        return []
    sampled = df.select(value).sample(EDGE_SAMPLE, seed=1)
    return sorted(set(sampled.approxQuantile(value, shares, 0.25 / buckets)))


def add_bucket(df: DataFrame, value: str, edges: Sequence[float], name: str = "_bucket") -> DataFrame:
    if not edges:
        return df.withColumn(name, F.lit(0))
    cuts = [-math.inf, *edges, math.inf]
    tagged = Bucketizer(splits=cuts, inputCol=value, outputCol="_cut", handleInvalid="keep").transform(df)
    return tagged.select(*df.columns, F.col("_cut").cast("int").alias(name))


def _group_column(by: Sequence[str]) -> Column:
    # A struct is never null itself, so groups with null keys join like any other.
    return F.struct(*by) if by else F.lit(0)


def numbered(df: DataFrame, value: str, ties: Sequence[str]) -> DataFrame:
    """The rows with ``_rank`` from 0 in the order of (value, ties), which must tell rows apart; values are not null.

    Each bucket is numbered on its own and shifted by the rows before it. A value that fills whole buckets gets a bucket
    of its own, which is cut by the first tie column, a 64-bit hash.
    """
    buckets = bucket_count(df)
    shares = [i / buckets for i in range(1, buckets)]
    cuts = df.select(value).sample(EDGE_SAMPLE, seed=1).approxQuantile(value, shares, 0.25 / buckets) or [0.0]
    heavy = {a for a, b in zip(cuts, cuts[1:]) if a == b}
    edges = sorted({*cuts, *heavy, *(math.nextafter(v, math.inf) for v in heavy)})
    place = F.when(F.col(value).isin(*heavy), F.shiftright(ties[0], 56) + 128).otherwise(0) if heavy else F.lit(0)
    placed = add_bucket(df, value, edges, "_bucket").withColumn("_part", place.cast("int"))
    before = "rows between unbounded preceding and 1 preceding"
    offsets = placed.groupBy("_bucket", "_part").count().selectExpr(
        "_bucket", "_part", f"coalesce(sum(count) over (order by _bucket, _part {before}), 0) as _offset")  # one row per bucket part
    order = ", ".join(f"`{c}`" for c in (value, *ties))
    inside = f"row_number() over (partition by _bucket, _part order by {order}) - 1"
    return placed.join(offsets, ["_bucket", "_part"]).selectExpr(*_quoted(df.columns), f"{inside} + _offset as _rank")


def _has_rank(value: str) -> Column:
    """Neither null nor NaN: those have no place among the values."""
    return F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def _ungroup(df: DataFrame, by: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c != "_group"]
    return df.select(*(F.col("_group")[c].alias(c) for c in by), *rest)


def running_totals(
    df: DataFrame, value: str, totals: Mapping[str, Column], by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Sums per distinct value, over smaller values, and over the whole group.

    For every entry ``n`` of ``totals`` the result has ``n`` (at this value),
    ``n_before`` (at smaller values of the group) and ``n_all`` (in the group).
    """
    names = list(totals)
    kept = df.where(_has_rank(value)).withColumn("_group", _group_column(by))
    kept = kept.select("_group", F.col(value).cast("double").alias(value), *(c.alias(n) for n, c in totals.items()))
    cells = (
        add_bucket(kept, value, bucket_edges(kept, value, buckets), "_bucket")
        .groupBy("_group", "_bucket", value)
        .agg(*(F.sum(n).alias(n) for n in names))
    )
    before = "rows between unbounded preceding and 1 preceding"
    offsets = (
        cells.groupBy("_group", "_bucket")
        .agg(*(F.sum(n).alias(n) for n in names))
        .selectExpr(
            "_group",
            "_bucket",
            *(f"coalesce(sum({n}) over (partition by _group order by _bucket {before}), 0) as _{n}_offset" for n in names),
            *(f"sum({n}) over (partition by _group) as {n}_all" for n in names),
        )
    )
    inside = f"over (partition by _group, _bucket order by `{value}` {before})"
    ranked = (
        cells.selectExpr("*", *(f"coalesce(sum({n}) {inside}, 0) as _{n}_inside" for n in names))
        .join(offsets, ["_group", "_bucket"])
        .selectExpr(
            "_group",
            f"`{value}`",
            *names,
            *(f"_{n}_inside + _{n}_offset as {n}_before" for n in names),
            *(f"{n}_all" for n in names),
        )
    )
    return _ungroup(ranked, by)


def overlapping_sums(
    df: DataFrame, value: str, totals: Mapping[str, Column], groups: DataFrame, on: str, work: Callable[[np.ndarray, dict[str, np.ndarray]], dict], schema: str,
    by: Sequence[str] = (), buckets: int | None = None,
) -> DataFrame:
    """What ``work`` makes of the ``running_totals`` of groups that share rows: a row (``by``, group, ``schema``) per group and bucket of values.

    ``groups`` has ``on``, such as a day, and the columns that name a group it is in. ``work`` gets the distinct values of a bucket in
    order and, by name, the arrays ``n``, ``n_before`` and ``n_all`` of ``running_totals``; its figures, long or double, must be ones that buckets can be put
    together from, such as sums. Values of ``on`` that are in the same groups are one span. Rows are counted and moved once per span,
    whatever the number of their groups; a task sorts a bucket once and picks each group's rows from it in that order. A bucket
    has about ``BUCKET_ROWS`` rows. A null ``on`` is a value of its own. ``groups`` and groups x buckets are small tables.
    """
    import pyarrow as pa
    names, own = list(totals), [c for c in groups.columns if c != on]
    sets = groups.groupBy(on).agg(F.array_sort(F.collect_set(F.struct(*own))).alias("_groups"))  # a row per day
    spans = settled(sets.selectExpr(f"`{on}` as _on", "_groups", "int(dense_rank() over (order by _groups)) as _span"))
    kept = df.where(_has_rank(value)).withColumn("_group", _group_column(by))
    kept = kept.join(F.broadcast(spans.select("_on", "_span")), F.col(on).eqNullSafe(F.col("_on")))
    kept = kept.select("_group", "_span", F.col(value).cast("double").alias("_value"), *(c.alias(n) for n, c in totals.items()))
    buckets = buckets or max(bucket_count(df), -(-df.count() // BUCKET_ROWS))
    placed = add_bucket(kept, "_value", bucket_edges(kept, "_value", buckets), "_bucket")
    added = [F.sum(n).alias(n) for n in names]
    members = spans.select("_span", "_groups").distinct().select("_span", F.explode("_groups").alias("_in")).selectExpr(
        "_span", "_in", "int(dense_rank() over (order by _in)) as _id")  # a row per span and group
    before = "rows between unbounded preceding and 1 preceding"
    offsets = settled(placed.groupBy("_group", "_span", "_bucket").agg(*added).join(F.broadcast(members), "_span").groupBy("_group", "_in", "_id", "_bucket").agg(
        *added, F.array_sort(F.collect_set("_span")).alias("_spans")).selectExpr(
        "_group", "_bucket", "_in", "_id", "_spans",
        *(f"coalesce(sum({n}) over (partition by _group, _id order by _bucket {before}), 0) as _{n}_offset" for n in names),
        *(f"sum({n}) over (partition by _group, _id) as _{n}_all" for n in names)))  # groups x buckets
    cells = placed.groupBy("_group", "_span", "_bucket", "_value").agg(*added)
    made = dict(c.split() for c in schema.split(", "))
    kinds = {"long": pa.int64(), "double": pa.float64()}

    def bucket(rows: pa.Table, of: pa.Table) -> pa.Table:
        values = rows["_value"].to_numpy() + 0.0  # -0.0 and 0.0 are one value
        order = np.argsort(values, kind="stable")
        values, span = values[order], rows["_span"].to_numpy()[order]
        counts = {n: rows[n].to_numpy()[order] for n in names}
        by_span = np.argsort(span, kind="stable")
        numbers, starts = np.unique(span[by_span], return_index=True)
        places = dict(zip(numbers.tolist(), np.split(by_span, starts[1:]), strict=True))
        found: dict = {c: [] for c in made}
        for i, some in enumerate(of["_spans"].to_pylist()):
            inside = np.zeros(len(values), bool)
            for s in some:
                inside[places[s]] = True
            at = np.flatnonzero(inside)
            first = np.flatnonzero(np.r_[True, values[at[1:]] != values[at[:-1]]])
            sums = {n: np.add.reduceat(c[at], first) for n, c in counts.items()}
            known = dict(sums)
            for n, c in sums.items():
                known[f"{n}_before"] = np.cumsum(c) - c + of[f"_{n}_offset"][i].as_py()
                known[f"{n}_all"] = of[f"_{n}_all"][i].as_py()
            one = work(values[at[first]], known)
            for c in made:
                found[c].append(one[c])
        return pa.table([of["_group"], of["_in"], *(pa.array(found[c], kinds[k]) for c, k in made.items())], names=["_group", "_in", *made])

    result = offsets.select("_group", "_in").schema
    for name, kind in made.items():
        result = result.add(name, kind)
    pairs = cells.groupBy("_group", "_bucket").cogroup(offsets.groupBy("_group", "_bucket")).applyInArrow(bucket, result)
    return _ungroup(pairs.select("_group", *(F.col("_in")[c].alias(c) for c in own), *made), by)


def values_at_ranks(
    df: DataFrame,
    value: str,
    ranks: str,
    by: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """The values at given 0-based ranks of every group, ties counted.

    ``ranks`` is a SQL expression for an array of bigint ranks that may use the
    group's row count ``n``. Result: ``by``, ``n``, and ``picks``, an array of (rank, value, start) in rank order, where
    ``start`` is the rank of the first row with that value.

    Bucket counts alone tell which buckets hold the ranks. Only their rows, about
    (ranks / buckets) of the table, are shuffled and sorted.
    """
    kept = df.where(_has_rank(value)).select(
        _group_column(by).alias("_group"), F.col(value).cast("double").alias("_value")
    )
    tagged = add_bucket(kept, "_value", bucket_edges(kept, "_value", buckets))
    before = "over (partition by _group order by _bucket rows between unbounded preceding and 1 preceding)"
    wanted = (
        tagged.groupBy("_group", "_bucket")
        .agg(F.count("*").alias("_count"))
        .selectExpr(
            "*", f"coalesce(sum(_count) {before}, 0) as _offset", "sum(_count) over (partition by _group) as n"
        )
        .selectExpr(
            "_group", "_bucket", "n", "_offset",
            f"exists({ranks}, r -> r >= _offset and r < _offset + _count) as _hit",
        )
        .where("_hit")
        .drop("_hit")
    )
    # without groups there is at most one row per rank
    wanted = small_side(wanted) if by else F.broadcast(wanted)
    inside = "over (partition by _group, _bucket order by _value rows between unbounded preceding and 1 preceding)"
    found = (
        tagged.join(wanted, ["_group", "_bucket"])
        .groupBy("_group", "_bucket", "_value")
        .agg(F.count("*").alias("_count"), F.max("n").alias("n"), F.max("_offset").alias("_offset"))
        .selectExpr("_group", "n", "_value as value", "_count", f"_offset + coalesce(sum(_count) {inside}, 0) as start")
        .selectExpr(
            "_group", "n", "value", "start",
            f"explode(filter(array_distinct({ranks}), r -> r >= start and r < start + _count)) as rank",
        )
        # one entry per requested rank, so the array is as short as the request
        .groupBy("_group", "n")
        .agg(F.expr("array_sort(collect_list(struct(rank, value, start)))").alias("picks"))
    )
    return _ungroup(found, by)


def exact_quantiles(
    df: DataFrame, value: str, shares: Sequence[float], by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Linearly interpolated quantiles: ``by``, ``n`` and ``quantiles`` in the order of ``shares``."""
    points = ", ".join(f"{float(s)!r}D" for s in shares)
    ranks = (
        f"flatten(transform(array({points}), s -> array(cast(floor((n - 1) * s) as bigint),"
        " cast(ceil((n - 1) * s) as bigint))))"
    )
    interpolated = (
        f"transform(array({points}), s -> _at[cast(floor((n - 1) * s) as bigint)]"
        " + (_at[cast(ceil((n - 1) * s) as bigint)] - _at[cast(floor((n - 1) * s) as bigint)])"
        " * ((n - 1) * s - floor((n - 1) * s)))"
    )
    return (
        values_at_ranks(df, value, ranks, by, buckets)
        .selectExpr(*_quoted(by), "n", "map_from_entries(transform(picks, p -> struct(p.rank, p.value))) as _at")
        .selectExpr(*_quoted(by), "n", f"{interpolated} as quantiles")
    )


def quick_quantiles(
    df: DataFrame, value: str, shares: Sequence[float], by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """Same shape as ``exact_quantiles`` in one pass, with a rank error of n / accuracy."""
    df = df.withColumn("_ranked", F.when(_has_rank(value), F.col(value)))
    wanted = F.percentile_approx("_ranked", [float(s) for s in shares], accuracy)
    return df.groupBy(*by).agg(F.count("_ranked").alias("n"), wanted.cast("array<double>").alias("quantiles"))


def smallest_by_hash(df: DataFrame, key: Sequence[str], take: str, seed: int = 42, by: Sequence[str] = ()) -> DataFrame:
    """A repeatable random choice of exactly ``take`` rows per group, without a sort.

    Rows are taken in the order of a seeded hash of their key. ``take`` is a SQL
    expression that may use the group's row count ``n``. Keys must identify rows.
    """
    # 53 bits survive the cast to double unchanged, so the order is exact
    spot = F.shiftright(F.xxhash64(F.lit(seed), *key), 11).cast("double")
    last = f"array(cast({take} as bigint) - 1)"
    if not by:
        marked = df.withColumn("_spot", spot)
        cut = values_at_ranks(marked, "_spot", last).select(F.get("picks", F.lit(0))["value"]).scalar()
        return marked.where(F.col("_spot") <= cut).drop("_spot")
    marked = df.withColumn("_spot", spot).withColumn("_group", _group_column(by))
    cuts = values_at_ranks(marked, "_spot", last, ["_group"]).select(
        "_group", F.get("picks", F.lit(0))["value"].alias("_cut"))
    return marked.join(small_side(cuts), "_group").where(F.col("_spot") <= F.col("_cut")).drop("_spot", "_cut", "_group")
