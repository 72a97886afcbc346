"""Population stability and distribution profiles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.base import APPLICATIONS, LOWER, N, R, SCORED, UPPER, applications, query, scored, tidy, with_
from scorewarden.operators import drift

_CUT = dt.date(1999, 1, 1)
_CATS, _NUMS = ["place", "segment", "band"], ["amount", "balance"]
_INNER = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"
_ALL = "[0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]"


def _bin(x: str, edges: str = "edges", n: int = 9) -> str:
    return "(" + " + ".join(f"CASE WHEN {x} >= {edges}[{i}] THEN 1 ELSE 0 END" for i in range(1, n + 1)) + ")"


def _shares(cats) -> str:
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {c} AS value, COUNT(*) FILTER (WHERE dev) AS e, COUNT(*) FILTER (WHERE NOT dev) AS a FROM applications GROUP BY {c}""" for c in cats)
    return f"""shares AS (SELECT *, e / CAST(SUM(e) OVER (PARTITION BY feature) AS DOUBLE) AS er, a / CAST(SUM(a) OVER (PARTITION BY feature) AS DOUBLE) AS ar FROM ({parts}))"""


_TERM = "(GREATEST({a}, 1e-10) - GREATEST({e}, 1e-10)) * LN(GREATEST({a}, 1e-10) / GREATEST({e}, 1e-10))"
_CATPSI = f"""catpsi AS (SELECT feature, SUM({_TERM.format(a='ar', e='er')}) AS psi,
  COUNT(*) FILTER (WHERE e = 0 AND a > 0) AS unseen_count, SUM(CASE WHEN e = 0 THEN ar ELSE 0 END) AS unseen_ratio FROM shares GROUP BY feature)"""


@query("psi_category", with_(APPLICATIONS, _shares(_CATS), _CATPSI, select=f"""SELECT feature, {R('psi')} AS psi, unseen_count, {R('unseen_ratio')} AS unseen_ratio FROM catpsi"""))
def psi_category(spark, folder):
    return tidy(drift.category_psi(applications(spark, folder), _CATS, "dev"))


@query("unseen_categories", with_(APPLICATIONS, _shares(["place", "segment"]), select="SELECT feature, value, a AS n FROM shares WHERE value IS NOT NULL AND e = 0 AND a > 0"))
def unseen_categories(spark, folder):
    return drift.unseen_values(applications(spark, folder), ["place", "segment"], "dev")


@query("unseen_summary", with_(APPLICATIONS, _shares(["place", "segment"]), select=f"""SELECT feature,
  COUNT(*) FILTER (WHERE value IS NOT NULL AND e > 0) AS dev_category_count, COUNT(*) FILTER (WHERE value IS NOT NULL AND a > 0) AS oot_category_count,
  COUNT(*) FILTER (WHERE value IS NOT NULL AND e = 0) AS unseen_categories,
  {N("SUM(CASE WHEN value IS NOT NULL AND e = 0 THEN a ELSE 0 END)")} AS unseen_count,
  {R("SUM(CASE WHEN value IS NOT NULL AND e = 0 THEN a ELSE 0 END) / CAST(SUM(a) AS DOUBLE)")} AS unseen_ratio FROM shares GROUP BY feature"""))
def unseen_summary(spark, folder):
    return tidy(drift.unseen_summary(applications(spark, folder), ["place", "segment"], "dev"))


_LONG = "long AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x, dev FROM applications WHERE {c} IS NOT NULL" for c in _NUMS) + ")"
_BINNED = f"""edges AS (SELECT feature, quantile_cont(x, {_INNER}) AS edges FROM long WHERE dev GROUP BY feature),
counts AS (SELECT feature, {_bin('x')} AS bin, COUNT(*) FILTER (WHERE dev) AS e, COUNT(*) FILTER (WHERE NOT dev) AS a FROM long JOIN edges USING (feature) GROUP BY 1, 2),
grid AS (SELECT DISTINCT feature, CAST(b AS INTEGER) AS bin FROM long, range(0, 10) t(b)),
bins AS (SELECT g.feature, g.bin, COALESCE(e, 0) / CAST(SUM(e) OVER w AS DOUBLE) AS er, COALESCE(a, 0) / CAST(SUM(a) OVER w AS DOUBLE) AS ar
  FROM grid g LEFT JOIN counts c ON g.feature = c.feature AND g.bin = c.bin WINDOW w AS (PARTITION BY g.feature))"""
_NUMPSI = f"SELECT feature, SUM({_TERM.format(a='ar', e='er')}) AS psi FROM bins GROUP BY feature"


@query("psi_numeric", with_(APPLICATIONS, _LONG, _BINNED, select=f"SELECT feature, {R('psi')} AS psi FROM ({_NUMPSI})"))
def psi_numeric(spark, folder):
    return tidy(drift.numeric_psi(applications(spark, folder), _NUMS, "dev"))


@query("psi_numeric_bins", with_(APPLICATIONS, _LONG, _BINNED, select=f"""SELECT feature, bin AS bin_index, {R('er')} AS expected_ratio,
  {R('ar')} AS actual_ratio, {R(_TERM.format(a='ar', e='er'))} AS bin_psi FROM bins"""))
def psi_numeric_bins(spark, folder):
    return tidy(drift.numeric_psi_bins(applications(spark, folder), _NUMS, "dev"))


# tied values: the discount has 11 distinct values, so decile edges repeat
_SLONG = "slong AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS x, day < DATE '1999-01-01' AS dev FROM scored" for c in ("score", "coarse", "discount")) + ")"


@query("psi_smoothed", with_(SCORED, _SLONG, f"""qs AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, {_ALL}))) AS edges FROM slong WHERE NOT dev GROUP BY feature)""",
  """inside AS (SELECT feature, dev, len(edges) - 1 AS nb, LEAST(len(edges) - 1, """ + " + ".join(
      f"CASE WHEN len(edges) >= {i} AND x >= edges[{i}] THEN 1 ELSE 0 END" for i in range(1, 12)) + """) AS bin
  FROM slong JOIN qs USING (feature) WHERE x >= edges[1] AND x <= edges[len(edges)])""",
  """c AS (SELECT f.feature, f.nb, b AS bin, (SELECT COUNT(*) FROM inside i WHERE i.feature = f.feature AND i.bin = b AND dev) AS e,
    (SELECT COUNT(*) FROM inside i WHERE i.feature = f.feature AND i.bin = b AND NOT dev) AS a
    FROM (SELECT feature, len(edges) - 1 AS nb FROM qs) f, range(1, 11) t(b) WHERE b <= nb)""",
  """p AS (SELECT feature, (e + 1e0) / (SUM(e) OVER w + nb) AS er, (a + 1e0) / (SUM(a) OVER w + nb) AS ar FROM c WINDOW w AS (PARTITION BY feature))""",
  select=f"SELECT feature, {R('SUM((er - ar) * LN(er / ar))')} AS psi FROM p GROUP BY feature"))
def psi_smoothed(spark, folder):
    rows = scored(spark, folder).withColumn("dev", F.col("day") < F.lit(_CUT))
    return tidy(drift.smoothed_psi(rows, ["score", "coarse", "discount"], "dev"))


@query("psi_tied_scores", with_(SCORED, _SLONG, _BINNED.replace("long", "slong"), select=f"SELECT feature, {R('psi')} AS psi FROM ({_NUMPSI})"))
def psi_tied_scores(spark, folder):
    rows = scored(spark, folder).withColumn("dev", F.col("day") < F.lit(_CUT))
    return tidy(drift.numeric_psi(rows, ["score", "coarse", "discount"], "dev"))


@query("psi_by_month", with_(SCORED, f"""base AS (SELECT quantile_cont(score, {_INNER}) AS edges FROM scored WHERE day < DATE '1999-01-01')""",
  f"""tagged AS (SELECT strftime(day, '%Y-%m') AS month, {_bin('score')} AS bin, day < DATE '1999-01-01' AS dev FROM scored, base)""",
  """e AS (SELECT b AS bin, (SELECT COUNT(*) FROM tagged WHERE dev AND bin = b) / CAST((SELECT COUNT(*) FROM tagged WHERE dev) AS DOUBLE) AS er FROM range(0, 10) t(b))""",
  """a AS (SELECT month, COUNT(*) AS n FROM tagged WHERE NOT dev GROUP BY month)""",
  """c AS (SELECT month, bin, COUNT(*) AS k FROM tagged WHERE NOT dev GROUP BY 1, 2)""",
  select=f"""SELECT a.month, {R("SUM(" + _TERM.format(a="(COALESCE(k, 0) / CAST(n AS DOUBLE))", e="er") + ")")} AS psi
  FROM a JOIN e ON TRUE LEFT JOIN c ON c.month = a.month AND c.bin = e.bin GROUP BY a.month"""))
def psi_by_month(spark, folder):
    rows = scored(spark, folder).withColumn("month", F.date_format("day", "yyyy-MM"))
    early = F.col("day") < F.lit(_CUT)
    return tidy(drift.psi_by_group(rows.where(~early), "score", rows.where(early), ["month"]))


_REPORT = with_(APPLICATIONS, _shares([*_CATS, "label"]), _CATPSI, _LONG, _BINNED, f"numpsi AS ({_NUMPSI})", """report AS (
  SELECT feature, CASE WHEN feature = 'label' THEN 'label' ELSE 'category' END AS drift_type, psi FROM catpsi
  UNION ALL SELECT feature, 'numeric', psi FROM numpsi)""", select="{}")


@query("drift_report", _REPORT.format(f"SELECT feature, drift_type, {R('psi')} AS psi, psi >= 0.1e0 AS is_significant, psi >= 0.25e0 AS is_critical FROM report"))
def drift_report(spark, folder):
    return tidy(drift.drift_report(applications(spark, folder), "dev", _CATS, _NUMS, "label"))


@query("drift_summary", _REPORT.format("""SELECT COUNT(*) AS total_features_checked, COUNT(*) FILTER (WHERE psi >= 0.1e0) AS significant_drift_count,
  COUNT(*) FILTER (WHERE psi >= 0.25e0) AS critical_drift_count FROM report"""))
def drift_summary(spark, folder):
    return drift.drift_summary(drift.drift_report(applications(spark, folder), "dev", _CATS, _NUMS, "label"))


@query("drift_moments", with_(APPLICATIONS, _LONG, select="SELECT feature, " + ", ".join(
    f"{R(f'{f}(x) FILTER (WHERE {t})', 4)} AS {s}_{n}" for s, t in (("dev", "dev"), ("oot", "NOT dev")) for n, f in (("mean", "AVG"), ("std", "STDDEV_POP"))) + " FROM long GROUP BY feature"))
def drift_moments(spark, folder):
    return tidy(drift.numeric_moments(applications(spark, folder), _NUMS, "dev"), 4)


@query("number_statistics", with_(APPLICATIONS, _LONG, select=f"""SELECT feature, COUNT(x) AS count, {R('AVG(x)', 4)} AS mean, {R('STDDEV_SAMP(x)', 4)} AS std,
  {R('MIN(x)', 4)} AS min, {R('MAX(x)', 4)} AS max FROM long GROUP BY feature"""))
def number_statistics(spark, folder):
    return tidy(drift.number_statistics(applications(spark, folder), _NUMS), 4)


@query("level_statistics", with_(APPLICATIONS, "seen AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, COUNT(*) AS n FROM applications GROUP BY {c}" for c in _CATS) + ")",
  select="""SELECT feature, unique_count, CAST(rn AS INTEGER) AS rank, value, n FROM (SELECT *, COUNT(*) OVER (PARTITION BY feature) AS unique_count,
  ROW_NUMBER() OVER (PARTITION BY feature ORDER BY n DESC, value NULLS FIRST) AS rn FROM seen) WHERE rn <= 5"""))
def level_statistics(spark, folder):
    return drift.level_statistics(applications(spark, folder), _CATS)


def _spread(x: str) -> str:
    return f"""COUNT({x}) AS n, CAST(0 AS BIGINT) AS n_nan, {R(f'AVG({x})')} AS mean, {R(f'STDDEV_POP({x})')} AS std, {R(f'MIN({x})')} AS min, {R(f'MAX({x})')} AS max,
      {R(f'quantile_cont({x}, 0.25)')} AS q25, {R(f'quantile_cont({x}, 0.5)')} AS median, {R(f'quantile_cont({x}, 0.75)')} AS q75"""


@query("score_distribution", with_(SCORED, select=f"SELECT {_spread('score')} FROM scored"))
def score_distribution(spark, folder):
    return tidy(drift.score_distribution(scored(spark, folder), "score"))


@query("score_distribution_by_segment", with_(SCORED, select=f"SELECT segment, {_spread('coarse')} FROM scored GROUP BY segment"))
def score_distribution_by_segment(spark, folder):
    return tidy(drift.score_distribution(scored(spark, folder), "coarse", ["segment"]))


_MIX = "COUNT(*) AS total, " + ", ".join(
    f"COUNT(*) FILTER (WHERE {t}) AS zone_{z}_count, {R(f'COUNT(*) FILTER (WHERE {t}) / CAST(COUNT(*) AS DOUBLE)')} AS zone_{z}_ratio"
    for z, t in (("high", "score >= 0.85e0"), ("manual", "score >= 0.5e0 AND score < 0.85e0"), ("low", "score < 0.5e0")))


@query("zone_mix_by_month", with_(SCORED, select=f"SELECT strftime(day, '%Y-%m') AS month, {_MIX} FROM scored GROUP BY 1"))
def zone_mix_by_month(spark, folder):
    return tidy(drift.zone_mix(scored(spark, folder).withColumn("month", F.date_format("day", "yyyy-MM")), "score", LOWER, UPPER, ["month"]))


_ZONES = {"high": "score >= 0.85e0", "manual": "score >= 0.5e0 AND score < 0.85e0", "low": "score < 0.5e0"}
_BASEMIX = "basemix AS (SELECT " + ", ".join(f"COUNT(*) FILTER (WHERE {t}) / CAST(COUNT(*) AS DOUBLE) AS b_{z}" for z, t in _ZONES.items()) + " FROM scored WHERE day < DATE '1999-01-01')"
_NOWMIX = "nowmix AS (SELECT segment, COUNT(*) AS total, " + ", ".join(f"COUNT(*) FILTER (WHERE {t}) AS c_{z}, COUNT(*) FILTER (WHERE {t}) / CAST(COUNT(*) AS DOUBLE) AS r_{z}" for z, t in _ZONES.items()) + " FROM scored WHERE day >= DATE '1999-01-01' GROUP BY segment)"
_MAX = "GREATEST(" + ", ".join(f"ABS(r_{z} - b_{z})" for z in _ZONES) + ")"


@query("zone_shift", with_(SCORED, _BASEMIX, _NOWMIX, select="SELECT segment, total, " + ", ".join(
    f"c_{z} AS zone_{z}_count, {R(f'r_{z}')} AS zone_{z}_ratio, {R(f'b_{z}')} AS baseline_zone_{z}_ratio, {R(f'r_{z} - b_{z}')} AS zone_{z}_shift" for z in _ZONES)
    + f", {R(_MAX)} AS max_shift, {_MAX} >= 0.10e0 AS shift_warning FROM nowmix, basemix"))
def zone_shift(spark, folder):
    rows, early = scored(spark, folder), F.col("day") < F.lit(_CUT)
    return tidy(drift.zone_shift(rows.where(~early), "score", rows.where(early), LOWER, UPPER, ["segment"]))
