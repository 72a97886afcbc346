"""Feature and error diagnosis of the scored line items."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.base import CUT, DATA_START, R, SCORED, WINDOWS, query, scored, tidy, with_
from catalog.drift import _ALL
from scorewarden import vocabulary as v
from scorewarden.functions import score_zone
from scorewarden.operators import diagnosis
from scorewarden.operators.splits import rolling_windows

_FEATURES = ["score", "coarse", "discount", "tax"]
_CLASSES = [(["a"], "with_a"), (["e"], "with_e")]
_CUT = dt.date(2000, 1, 1)


def _featured(spark, folder):
    """Features with nulls, label, and the development flag."""
    return scored(spark, folder).withColumns({
        "dev": F.col("day") < F.lit(_CUT), "tax": F.when(F.col("l_orderkey") % 7 != 0, F.col("tax"))})


FEATURED = "featured AS (SELECT * EXCLUDE (tax), CASE WHEN l_orderkey % 7 <> 0 THEN tax END AS tax, day < DATE '2000-01-01' AS dev FROM scored)"


def _long(name: str, columns: str, where: str = "TRUE", fill: bool = False) -> str:
    return f"{name} AS (" + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f'COALESCE({f}, 0)' if fill else f} AS x, {columns} FROM featured WHERE {where}" for f in _FEATURES) + ")"


_CORR = [SCORED, FEATURED, _long("filled", "1 - label AS reject", fill=True),
         "q AS (SELECT feature, quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.75) AS b FROM filled GROUP BY 1)",
         """correlation AS (SELECT feature, CASE WHEN isnan(CORR(x, reject)) THEN 0 ELSE COALESCE(CORR(x, reject), 0) END AS c,
           CASE WHEN MAX(a) <> MAX(b) THEN AVG(reject) FILTER (WHERE x <= a) ELSE AVG(reject) END AS low,
           CASE WHEN MAX(a) <> MAX(b) THEN AVG(reject) FILTER (WHERE x >= b) ELSE AVG(reject) END AS high FROM filled JOIN q USING (feature) GROUP BY 1)"""]


@query("reject_correlation", with_(*_CORR, select=f"""SELECT feature, {R('c')} AS corr_with_reject, {R('ABS(c)')} AS abs_corr_with_reject, {R('low')} AS reject_rate_q25,
  {R('high')} AS reject_rate_q75, {R('high - low')} AS reject_lift_q75_vs_q25 FROM correlation"""))
def reject_correlation(spark, folder):
    return diagnosis.reject_correlation(_featured(spark, folder), "label", _FEATURES, places=6)


_WINDOWED = [_long("walong", "day"), """wmeans AS (SELECT feature, window_id, ROUND(AVG(x), 4) AS m FROM walong JOIN windows ON day BETWEEN train_start AND monitor_end GROUP BY 1, 2)"""]


@query("window_means", with_(SCORED, FEATURED, WINDOWS, *_WINDOWED, select=f"SELECT window_id, feature, {R('m', 4)} AS mean FROM wmeans"))
def window_means(spark, folder):
    return tidy(diagnosis.window_means(_featured(spark, folder), rolling_windows(spark, DATA_START, CUT), "day", _FEATURES), 4)


_STABLE = [
    WINDOWS, *_WINDOWED, _long("sides", "dev"),
    f"qs AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, {_ALL}))) AS edges FROM sides WHERE NOT dev AND x IS NOT NULL GROUP BY feature)",
    """inside AS (SELECT feature, dev, LEAST(len(edges) - 1, """ + " + ".join(f"CASE WHEN len(edges) >= {i} AND x >= edges[{i}] THEN 1 ELSE 0 END" for i in range(1, 12)) + """) AS bin
      FROM sides JOIN qs USING (feature) WHERE x >= edges[1] AND x <= edges[len(edges)])""",
    """cells AS (SELECT f.feature, nb, b AS bin, (SELECT COUNT(*) FROM inside i WHERE i.feature = f.feature AND i.bin = b AND dev) AS e,
      (SELECT COUNT(*) FROM inside i WHERE i.feature = f.feature AND i.bin = b AND NOT dev) AS a FROM (SELECT feature, len(edges) - 1 AS nb FROM qs) f, range(1, 11) t(b) WHERE b <= nb)""",
    """psis AS (SELECT feature, SUM((er - ar) * LN(er / ar)) AS psi FROM (SELECT feature, (e + 1e0) / (SUM(e) OVER w + nb) AS er, (a + 1e0) / (SUM(a) OVER w + nb) AS ar
      FROM cells WINDOW w AS (PARTITION BY feature)) GROUP BY 1)""",
    """moments AS (SELECT feature, AVG(x) FILTER (WHERE dev) AS dm, STDDEV_SAMP(x) FILTER (WHERE dev) AS ds, AVG(x) FILTER (WHERE NOT dev) AS om, STDDEV_SAMP(x) FILTER (WHERE NOT dev) AS os,
      AVG(CASE WHEN x IS NULL THEN 1 ELSE 0 END) FILTER (WHERE dev) AS dn, AVG(CASE WHEN x IS NULL THEN 1 ELSE 0 END) FILTER (WHERE NOT dev) AS o_n FROM sides GROUP BY 1)""",
    "variation AS (SELECT feature, CASE WHEN COUNT(m) > 1 AND AVG(m) <> 0 THEN STDDEV_POP(m) / AVG(m) ELSE 0 END AS cv FROM wmeans GROUP BY 1)",
    "stability AS (SELECT *, ABS(om - dm) / (ds + 1e-8) AS shift FROM moments JOIN psis USING (feature) JOIN variation USING (feature))",
]


@query("feature_stability", with_(SCORED, FEATURED, *_STABLE, select=f"""SELECT feature, {R('dm')} AS dev_mean, {R('ds')} AS dev_std, {R('om')} AS oot_mean, {R('os')} AS oot_std,
  {R('shift')} AS mean_shift_zscore, {R('dn')} AS dev_missing_rate, {R('o_n')} AS oot_missing_rate, {R('o_n - dn')} AS missing_rate_change, {R('psi')} AS psi_dev_vs_oot,
  {R('cv')} AS temporal_cv, psi > 0.1e0 OR shift > 0.5e0 OR cv > 0.15e0 AS is_unstable FROM stability"""))
def feature_stability(spark, folder):
    return tidy(diagnosis.feature_stability(
        _featured(spark, folder), rolling_windows(spark, DATA_START, CUT), day="day", reference="dev", features=_FEATURES))


FLAGGED = """flagged AS (SELECT *, 1 - label AS actual_reject, CASE WHEN score < 0.5e0 THEN 1 ELSE 0 END AS pred_reject, CASE WHEN score >= 0.85e0 THEN 1 ELSE 0 END AS pred_approve,
  CASE WHEN score >= 0.85e0 AND label = 0 THEN 1 ELSE 0 END AS "is_FP", CASE WHEN score < 0.5e0 AND label = 1 THEN 1 ELSE 0 END AS "is_FN",
  CASE WHEN (score >= 0.85e0 AND label = 1) OR (score < 0.5e0 AND label = 0) THEN 1 ELSE 0 END AS is_correct,
  CASE WHEN score < 0.5e0 THEN 0 WHEN score >= 0.85e0 THEN 2 ELSE 1 END AS zone FROM featured)"""


def _flagged(spark, folder):
    rows = _featured(spark, folder).withColumns({"lower": F.lit(0.5), "upper": F.lit(0.85), "zone": score_zone(F.col("score"), 0.5, 0.85)})
    return diagnosis.error_flags(rows, "label", "score", "lower", "upper")


@query("error_flags", with_(SCORED, FEATURED, FLAGGED, select="""SELECT segment, zone, COUNT(*) AS n, """ + ", ".join(
    f'CAST(SUM("{c}") AS BIGINT) AS "{c}"' for c in ("actual_reject", "pred_reject", "pred_approve", "is_FP", "is_FN", "is_correct")) + " FROM flagged GROUP BY 1, 2"))
def error_flags(spark, folder):
    return _flagged(spark, folder).groupBy("segment", "zone").agg(F.count("*").alias("n"), *(
        F.sum(c).alias(c) for c in ("actual_reject", "pred_reject", "pred_approve", "is_FP", "is_FN", "is_correct")))


_SEGMENTS = [f"""bins AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, [0, 0.2, 0.4, 0.6, 0.8, 1]))) AS e FROM (
    SELECT 'discount' AS feature, discount AS x FROM flagged UNION ALL SELECT 'coarse', coarse FROM flagged) GROUP BY 1)""",
  """rowsx AS (SELECT 'segment' AS segment_feature, segment AS segment_value, flagged.* EXCLUDE (segment) FROM flagged
    UNION ALL SELECT 'place', CAST(CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_partkey % 50 END AS VARCHAR), flagged.* EXCLUDE (segment) FROM flagged
    """ + " ".join(f"""UNION ALL SELECT '{c}', CAST(GREATEST(0, """ + " + ".join(f"CASE WHEN len(e) >= {i} AND {c} > e[{i}] THEN 1 ELSE 0 END" for i in range(2, 7)) + f""") AS VARCHAR), flagged.* EXCLUDE (segment)
      FROM flagged, bins WHERE feature = '{c}'""" for c in ("discount", "coarse")) + ")",
  f"""segments AS (SELECT segment_feature, segment_value, COUNT(*) AS count, {R('COUNT(*) / CAST((SELECT COUNT(*) FROM flagged) AS DOUBLE)')} AS count_pct,
    {R('AVG(actual_reject)')} AS reject_rate, {R('AVG("is_FP")')} AS fp_rate, {R('AVG("is_FN")')} AS fn_rate, CAST(SUM("is_FP") AS BIGINT) AS fp_count,
    CAST(SUM("is_FN") AS BIGINT) AS fn_count, {R('AVG(score)')} AS avg_pred_prob, {R('AVG(CASE WHEN zone = 2 THEN 1 ELSE 0 END)')} AS high_zone_pct,
    {R('AVG(CASE WHEN zone = 1 THEN 1 ELSE 0 END)')} AS manual_zone_pct, {R('AVG(CASE WHEN zone = 0 THEN 1 ELSE 0 END)')} AS low_zone_pct
    FROM rowsx WHERE segment_value IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) >= 30)"""]


def _segments(spark, folder):
    rows = _flagged(spark, folder).withColumn("place", F.when(F.col("l_partkey") % 50 != 0, (F.col("l_partkey") % 50).cast("string")))
    return diagnosis.segment_errors(rows, levels=["segment", "place"], numbers=["discount", "coarse"], score="score", zone="zone", places=6)


@query("segment_errors", with_(SCORED, FEATURED, FLAGGED, *_SEGMENTS, select="SELECT * FROM segments"))
def segment_errors(spark, folder):
    return _segments(spark, folder)


@query("worst_segments", with_(SCORED, FEATURED, FLAGGED, *_SEGMENTS, select="SELECT segment_feature, segment_value, fp_rate FROM segments WHERE fp_rate > 0.05e0 ORDER BY fp_rate DESC, segment_feature, segment_value LIMIT 10"))
def worst_segments(spark, folder):
    return diagnosis.worst_segments(_segments(spark, folder)).select("segment_feature", "segment_value", "fp_rate")


def _profile_ctes(error: str, out: str) -> list[str]:
    return [_long(f"{out}_rows", f'"{error}" = 1 AS bad').replace("FROM featured", "FROM flagged"),
            f"""{out} AS (SELECT feature, AVG(x) AS overall_mean, STDDEV_SAMP(x) AS overall_std, AVG(x) FILTER (WHERE bad) AS error_mean, STDDEV_SAMP(x) FILTER (WHERE bad) AS error_std,
              AVG(CASE WHEN x IS NULL THEN 1 ELSE 0 END) FILTER (WHERE bad) AS error_missing_rate, AVG(CASE WHEN x IS NULL THEN 1 ELSE 0 END) AS overall_missing_rate,
              COUNT(*) FILTER (WHERE bad) AS error_count FROM {out}_rows GROUP BY 1)"""]


_PROFILE = "SELECT feature, error_count, " + ", ".join(f"{R(c)} AS {c}" for c in (
    "overall_mean", "overall_std", "error_mean", "error_std", "error_missing_rate", "overall_missing_rate")) + (
    f", {R('error_mean - overall_mean')} AS mean_diff, {R('(error_mean - overall_mean) / (overall_std + 1e-8)')} AS mean_diff_zscore FROM ")


@query("error_profile_fp", with_(SCORED, FEATURED, FLAGGED, *_profile_ctes("is_FP", "fp"), select=_PROFILE + "fp"))
def error_profile_fp(spark, folder):
    return tidy(diagnosis.error_profile(_flagged(spark, folder), "is_FP", _FEATURES))


@query("error_profile_fn", with_(SCORED, FEATURED, FLAGGED, *_profile_ctes("is_FN", "fn"), select=_PROFILE + "fn"))
def error_profile_fn(spark, folder):
    return tidy(diagnosis.error_profile(_flagged(spark, folder), "is_FN", _FEATURES))


@query("zone_errors", with_(SCORED, FEATURED, FLAGGED, select=f"""SELECT zone, COUNT(*) AS count, {R('COUNT(*) / CAST((SELECT COUNT(*) FROM flagged) AS DOUBLE)')} AS count_pct,
  CAST(SUM(actual_reject) AS BIGINT) AS actual_reject_count, {R('AVG(actual_reject)')} AS actual_reject_rate, CAST(SUM("is_FP") AS BIGINT) AS fp_count, {R('AVG("is_FP")')} AS fp_rate,
  CAST(SUM("is_FN") AS BIGINT) AS fn_count, {R('AVG("is_FN")')} AS fn_rate, {R('AVG(score)')} AS avg_pred_prob, {R('STDDEV_SAMP(score)')} AS std_pred_prob,
  {R('CASE WHEN zone = 2 THEN 1 - AVG(actual_reject) END')} AS precision_approve, {R('CASE WHEN zone = 0 THEN AVG(actual_reject) END')} AS precision_reject FROM flagged GROUP BY zone"""))
def zone_errors(spark, folder):
    return diagnosis.zone_errors(_flagged(spark, folder), "score", "zone", places=6)


_TABLE = [SCORED, FEATURED, FLAGGED, *_CORR[2:], *_STABLE, *_profile_ctes("is_FP", "fp"), *_profile_ctes("is_FN", "fn"),
          "gains AS (SELECT feature, ABS(c) AS gain FROM correlation)",
          """diagnosed AS (SELECT g.feature, gain / SUM(gain) OVER () AS gain_norm, CAST(RANK() OVER (ORDER BY gain DESC) AS INTEGER) AS rank_gain, c AS corr_with_reject, high - low AS lift,
            psi, shift, cv, psi > 0.1e0 OR shift > 0.5e0 OR cv > 0.15e0 AS is_unstable, (fp.error_mean - fp.overall_mean) / (fp.overall_std + 1e-8) AS fp_shift,
            (fn.error_mean - fn.overall_mean) / (fn.overall_std + 1e-8) AS fn_shift FROM gains g JOIN correlation USING (feature) JOIN stability USING (feature)
            JOIN fp USING (feature) JOIN fn USING (feature))"""]


def _diagnosed(spark, folder):
    featured, flagged = _featured(spark, folder), _flagged(spark, folder)
    correlation = diagnosis.reject_correlation(featured, "label", _FEATURES, places=6)
    stability = diagnosis.feature_stability(featured, rolling_windows(spark, DATA_START, CUT), day="day", reference="dev", features=_FEATURES)
    # stand-in for a model's gains, computed from the same data
    gains = flagged.select(*(F.abs(F.corr(F.coalesce(F.col(f), F.lit(0.0)), F.col("actual_reject"))).alias(f) for f in _FEATURES)).unpivot([], _FEATURES, "feature", "gain")
    ranked = diagnosis.rank_importance(gains, ["gain"], "gain").select("feature", "gain_norm", "rank_gain")
    return diagnosis.diagnosis_table(ranked, correlation, stability, diagnosis.error_profile(flagged, "is_FP", _FEATURES), diagnosis.error_profile(flagged, "is_FN", _FEATURES), _CLASSES)


@query("feature_diagnosis", with_(*_TABLE, select=f"""SELECT feature, {R('gain_norm')} AS gain_norm, rank_gain, {R('corr_with_reject')} AS corr_with_reject, {R('ABS(corr_with_reject)')} AS abs_corr_with_reject,
  {R('lift')} AS reject_lift_q75_vs_q25, {R('psi')} AS psi_dev_vs_oot, {R('shift')} AS mean_shift_zscore, {R('cv')} AS temporal_cv, is_unstable,
  {R('fp_shift')} AS fp_feature_shift, {R('fn_shift')} AS fn_feature_shift,
  CASE WHEN contains(feature, 'a') THEN 'with_a' WHEN contains(feature, 'e') THEN 'with_e' ELSE 'other' END AS feature_class FROM diagnosed"""))
def feature_diagnosis(spark, folder):
    return tidy(_diagnosed(spark, folder))


_EXPERIMENTS = ", ".join(f"('{i}', '{k}', {a}, {d})" for i, k, _, a, d, *_ in v.EXPERIMENTS)


@query("challenger_plan", with_(*_TABLE, "bad AS (SELECT string_agg(feature, ',' ORDER BY feature) AS k FROM diagnosed WHERE is_unstable OR gain_norm < 0.01e0)", select=f"""
  SELECT id AS challenger_id, kind AS model_type, CASE WHEN drops THEN coalesce(k, '') ELSE '' END AS removed, CASE WHEN adds THEN 'x,y' ELSE '' END AS added, 'same rows' AS judged
  FROM bad, (VALUES {_EXPERIMENTS}) t(id, kind, adds, drops)"""))
def challenger_plan(spark, folder):
    plan = diagnosis.challenger_plan(spark, _diagnosed(spark, folder), "gain_norm", v.EXPERIMENTS, ["x", "y"], {"judgement": "same rows"})
    return plan.select("challenger_id", "model_type", F.array_join("remove_features", ",").alias("removed"), F.array_join("add_features", ",").alias("added"),
                       F.col("protocol")["judgement"].alias("judged"))


@query("unstable_features", with_(*_TABLE, select=f"SELECT feature, {R('psi')} AS psi_dev_vs_oot FROM diagnosed WHERE is_unstable"))
def unstable_features(spark, folder):
    return tidy(diagnosis.unstable_features(_diagnosed(spark, folder)).select("feature", "psi_dev_vs_oot"))


@query("weak_features", with_(*_TABLE, select=f"SELECT feature, {R('gain_norm')} AS gain_norm FROM diagnosed WHERE gain_norm < 0.2e0"))
def weak_features(spark, folder):
    return tidy(diagnosis.weak_features(_diagnosed(spark, folder), "gain_norm", 0.2))


@query("top_reject_features", with_(*_CORR, select=f"SELECT feature, {R('c')} AS corr_with_reject FROM correlation ORDER BY ROUND(ABS(c), 6) DESC, feature LIMIT 3"))
def top_reject_features(spark, folder):
    return diagnosis.top_reject_features(diagnosis.reject_correlation(_featured(spark, folder), "label", _FEATURES, places=6), 3)


@query("predictions_with_features", with_(SCORED, """held AS (SELECT l_orderkey, MAX(score) AS score FROM scored GROUP BY 1)""", select=f"""
  SELECT h.l_orderkey, {R('h.score')} AS score, CAST(o.o_orderdate AS DATE) AS day, {R('o.o_totalprice')} AS score_gold FROM held h LEFT JOIN orders o ON h.l_orderkey = o.o_orderkey"""))
def predictions_with_features(spark, folder):
    from catalog.base import table
    held = scored(spark, folder).groupBy("l_orderkey").agg(F.max("score").alias("score"))
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").alias("score"))
    return tidy(diagnosis.with_features(held, orders, "l_orderkey", "label"))


@query("held_out_rows", with_(SCORED, """held AS (SELECT DISTINCT day FROM scored)""", select="""
  SELECT strftime(CAST(o_orderdate AS DATE), '%Y') AS year, COUNT(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) IN (SELECT day FROM held) GROUP BY 1"""))
def held_out_rows(spark, folder):
    from catalog.base import table
    orders = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    kept = diagnosis.held_out(orders, scored(spark, folder), ["day"])
    return kept.groupBy(F.date_format("day", "yyyy").alias("year")).agg(F.count("*").alias("n"))
