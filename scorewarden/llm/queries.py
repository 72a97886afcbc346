"""The operators over the whole tables they are meant for, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewarden.llm import (
    decontamination, divergence, fingerprints, lexical, linededup, lmscore, metrictree, mixing, neardup, personal, quality, secrets, substrings,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: White space of the line keys in DuckDB.
SQL_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_mix_sources")
def _(spark, folder):
    return mixing.mix_sources(table(spark, folder, "documents"))


def learnable(labels: DataFrame) -> DataFrame:
    return labels.where(~quality.held_out(F.col("doc_id")))


@query("op2_quality")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    weights = quality.fit(docs, learnable(table(spark, folder, "labels")))
    return quality.score(docs, weights).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query("op5_line_dedup", f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
keyed AS (SELECT r, i, line, translate(trim(line, {SQL_SPACE}), '{linededup.UPPER}', '{linededup.LOWER}') AS k FROM lines),
frequent AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, i, line, k IN (SELECT k FROM frequent) AS gone FROM keyed)
SELECT any_value(d.doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM kept JOIN docs d USING (r) GROUP BY r""")
def _(spark, folder):
    docs = linededup.drop_frequent_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


@query("op9_jaccard_join", r"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id,
  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (SELECT r, doc_id, CASE WHEN len(w) >= 5 THEN list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END AS s FROM docs),
kinds AS (SELECT row_number() OVER () AS k, s, len(s) AS n, min(doc_id) AS least, count(*) AS copies FROM sets WHERE s IS NOT NULL GROUP BY s),
shingles AS (SELECT k, n, unnest(s) AS g FROM kinds),
links AS (SELECT a.k AS a, b.k AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.k <> b.k GROUP BY 1, 2
  HAVING count(*) * 10 >= 8 * (any_value(a.n) + any_value(b.n) - count(*))),
reached(k, m) AS (SELECT k, k FROM kinds UNION SELECT l.a, r.m FROM reached r JOIN links l ON l.b = r.k),
classes AS (SELECT r.k, min(o.least) AS class_id FROM reached r JOIN kinds o ON o.k = r.m GROUP BY 1),
counts AS (SELECT a AS k, count(*) AS n_links FROM links GROUP BY 1)
SELECT doc_id, CASE WHEN sets.s IS NULL THEN doc_id ELSE class_id END AS class_id, coalesce(n_links, 0) AS n_links, coalesce(copies, 1) AS n_copies
FROM sets LEFT JOIN kinds USING (s) LEFT JOIN classes USING (k) LEFT JOIN counts USING (k)""")
def _(spark, folder):
    return neardup.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query("op10_decontamination")
def _(spark, folder):
    return decontamination.contaminated(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))


@query("op8_repeated_strings")
def _(spark, folder):
    return substrings.drop_repeats(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("_kept", 256).alias("kept_sha256"))


@query("op7_fingerprints")
def _(spark, folder):
    return fingerprints.version_fingerprints(table(spark, folder, "documents").select("doc_id", "text"))


@query("op3_secrets")
def _(spark, folder):
    found = secrets.secret_spans(table(spark, folder, "documents").select("doc_id", "text"))
    counts = [secrets.of_kind("_spans", i).alias(f"n_{k}") for i, k in enumerate(secrets.STRONG)]
    base = F.filter("_spans", lambda s: s["kind"] < len(secrets.STRONG))
    return found.select(
        "doc_id", *counts, F.sha2(secrets.span_list(base), 256).alias("base_sha256"), secrets.span_list(F.col("_spans")).alias("spans"))


@query("op4_personal_data")
def _(spark, folder):
    found = personal.personal_spans(table(spark, folder, "documents").select("doc_id", "text"))
    counts = [secrets.of_kind("_base", i).alias(f"n_{k}") for i, k in enumerate(personal.KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.span_list(F.col("_base"), personal.KINDS), 256).alias("base_sha256"),
        secrets.span_list(F.col("_spans"), personal.KINDS).alias("spans"))


@query("op6_lm_difference")
def _(spark, folder):
    good = learnable(table(spark, folder, "labels")).where("quality = 1")
    return lmscore.cross_entropy_difference(table(spark, folder, "documents").select("doc_id", "text"), good.select("doc_id"))


@query("op11_metric_search", r"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""")
def _(spark, folder):
    return metrictree.nearest_others(table(spark, folder, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0)


@query("op12_source_divergence", rf"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{linededup.UPPER}', '{linededup.LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
seen AS (SELECT r, lang, source, unnest(w) AS t FROM docs),
kept AS (SELECT lang, t FROM seen GROUP BY 1, 2 HAVING count(DISTINCT r) >= 30),
terms AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
cells AS (SELECT lang, source, t, count(*) AS n FROM seen JOIN kept USING (lang, t) GROUP BY 1, 2, 3),
groups AS (SELECT DISTINCT lang, source FROM docs),
sums AS (SELECT lang, source, coalesce(sum(n), 0) AS n, coalesce(any_value(v), 0) AS v
  FROM groups LEFT JOIN cells USING (lang, source) LEFT JOIN terms USING (lang) GROUP BY 1, 2),
shares AS (SELECT s.lang, s.source, t, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.n + 5 * s.v) AS p
  FROM sums s JOIN kept k USING (lang) LEFT JOIN cells c USING (lang, source, t)),
whole AS (SELECT lang, t, sum(n) AS n, any_value(v) AS v FROM cells JOIN terms USING (lang) GROUP BY 1, 2),
langs AS (SELECT lang, t, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q FROM whole),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM shares a JOIN shares b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
above AS (SELECT s.lang, s.source, 'term' AS part, t AS item, p - q AS value FROM shares s JOIN langs USING (lang, t) WHERE s.n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (FROM pairs UNION ALL FROM above))
SELECT lang, source, part, item, value::BIGINT AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 50""")
def _(spark, folder):
    return divergence.source_divergence(table(spark, folder, "documents"))


@query("op13_ranked_search", rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{linededup.UPPER}', '{linededup.LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), '{linededup.UPPER}', '{linededup.LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
asked AS (SELECT i, t, count(*) AS times FROM (SELECT i, unnest(w) AS t FROM items) GROUP BY 1, 2),
totals AS (SELECT count(*) AS n, sum(len(w)) AS l FROM docs WHERE len(w) > 0),
sizes AS (SELECT r, doc_id, 75 + (25 * len(w)::HUGEINT * n) // l AS m FROM docs, totals WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) WHERE t IN (SELECT t FROM asked) GROUP BY 1, 2),
weights AS (SELECT t, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY 1), totals),
scores AS (SELECT i, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (t) JOIN tf USING (t) JOIN sizes USING (r) GROUP BY 1, 2),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scores JOIN sizes USING (r) JOIN items USING (i) WHERE score > 0 AND doc_id IS NOT NULL)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20""")
def _(spark, folder):
    return lexical.ranked_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
