"""Metric-tree search, source divergence and dual-tree ranking against plain versions, and on odd input."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scorewarden.llm import divergence, lexical, metrictree
from scorewarden.llm.queries import QUERIES, SQL
from scorewarden.llm.terms import term_bytes, term_counts
from tests.llm.conftest import CLASHES, SMALL
from tests.oracle import compare

LETTERS, LETTERS_AND_DIGITS = "[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", ["op11_metric_search", "op12_source_divergence", "op13_ranked_search"])
def test_the_queries_agree_with_their_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SMALL) is None


@pytest.mark.parametrize("limit", [1 << 20, 64, 7])
def test_term_counts_cut_long_texts_only_between_terms(limit):
    texts = ["Aa aA b1b é-É", None, "", "x" * 300 + " y", " ".join(f"Word{i % 7}" for i in range(200)), "\x00\t", "end"]
    got = defaultdict(Counter)
    for row, code, count, terms in term_counts(pa.array(texts), term_bytes(digits=True), limit):
        for r, c, n in zip(row, code, count, strict=True):
            got[int(r)][terms[int(c)].as_py().decode()] += int(n)
    assert {i: c for i, c in got.items() if c} == {i: c for i, t in enumerate(texts) if (c := Counter(re.findall(LETTERS_AND_DIGITS, lower(t))))}


# ---- metric tree


def plain_search(rows, k):
    """[(query, rank, id, score)] of (id, vector) rows; queries are the ids divisible by 100."""
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(1024 * x) for x in v)]
    out = []
    for at, (i, v) in enumerate(ok):
        if i % 100 == 0:
            scores = [(-max(1 - (1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(v, w, strict=False)))), j) for n, (j, w) in enumerate(ok) if n != at]
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def searched(spark, rows, k=10, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in [*CLASHES, "rank", "label", "_v", "_id"]})
    return sorted(map(tuple, metrictree.nearest_others(df, F.pmod("vec_id", F.lit(100)) == 0, k=k, **more).collect()))


def test_search_equals_all_pairs_in_clusters_with_a_hot_vector(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 12))
    vectors = [(centres[i % 6] * (1 + i % 3) + 0.1 * rng.normal(size=12)).tolist() for i in range(900)]
    rows = [(i * 5, v if i % 3 else vectors[0]) for i, v in enumerate(vectors)]
    assert searched(spark, rows, 7) == plain_search(rows, 7)


def test_search_defines_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [0.5]), (100, []), (1, None), (None, [1.0]), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf")]),
        (5, [1e300, 1.0]), (6, [-1e300]), (7, [1.0, 2.0, 3.0]), (200, [-0.0, 0.0]), (8, [-0.0001]), (300, [1e306]), (9, [1.0, 2.0]), (10, [1.0, 2.0])]
    assert searched(spark, rows) == plain_search(rows, 10)
    assert searched(spark, rows[:1]) == [] and searched(spark, []) == []
    assert searched(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 1024 * 2048)]


def test_bounds_spare_most_products(spark):
    """In far clusters the stored distances keep a query out of all pages but those of its own cluster."""
    rng = np.random.default_rng(5)
    centres = np.eye(8) * 40
    x = np.floor(1024 * (centres[np.arange(800) % 8] + rng.normal(size=(800, 8))))
    rows = spark.createDataFrame([(i, (v / 1024).tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    tree = metrictree.build(metrictree.integer_vectors(rows), page=16, part_rows=200)
    pages = tree.pages.toArrow()
    nodes = [metrictree.Node(pages.filter(pa.compute.equal(pages["_node"], n)), tree.dim, tree.most) for n in pages["_node"].unique()]
    assert sum(len(n.x) for n in nodes) == 800 and max(np.diff(n.cuts).max() for n in nodes) <= 32
    for n in nodes:
        assert (n.d >= 0).all() and all((n.d[a:b] <= r + 1e-6).all() for a, b, r in zip(n.cuts[:-1], n.cuts[1:], n.radius, strict=True))
    seen, real = [], metrictree.inner
    metrictree.inner = lambda a, b: seen.append(len(a)) or real(a, b)
    try:
        best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]
        for n in sorted(nodes, key=lambda n: -float(n.parent @ x[0])):
            best = n.search(x[0], 5, best, -np.inf)
    finally:
        metrictree.inner = real
    assert best[0].tolist() == sorted((x @ x[0]).astype(int), reverse=True)[:5]
    assert sum(seen) < 400


# ---- divergence


def plain_divergence(rows, least, top):
    docs = [(lang or "", source or "", re.findall(LETTERS, lower(text))) for text, lang, source in rows]
    seen = Counter((lang, t) for lang, _, w in docs for t in set(w))
    kept = defaultdict(list)
    for (lang, t), n in seen.items():
        if n >= least:
            kept[lang].append(t)
    counts, whole = defaultdict(Counter), defaultdict(Counter)
    for lang, source, w in docs:
        good = set(kept[lang])
        counts[lang, source].update(t for t in w if t in good)
        whole[lang].update(t for t in w if t in good)
    p = lambda c, t, v: 1 + 10 ** 9 * (c[t] + 5) // (sum(c.values()) + 5 * v)
    out = []
    for lang, source in counts:
        v, c = len(kept[lang]), counts[lang, source]
        pairs = [(-sum(abs(p(c, t, v) - p(counts[lang, o], t, v)) for t in kept[lang]), o.encode(), o) for ol, o in counts if ol == lang and o != source]
        terms = [(p(whole[lang], t, v) - p(c, t, v), t.encode(), t) for t in kept[lang] if c[t] and p(c, t, v) > p(whole[lang], t, v)]
        out += [(lang, source, "pair", o, -f, i + 1) for i, (f, _, o) in enumerate(sorted(pairs))]
        out += [(lang, source, "term", t, -f, i + 1) for i, (f, _, t) in enumerate(sorted(terms)[:top])]
    return sorted(out)


@pytest.mark.parametrize("n", [1, 2, 5, 300, 5000])
def test_a_perfect_hash_is_a_bijection(n):
    terms = pa.array([f"t{i}".encode() for i in range(n)], pa.large_binary())
    h = divergence.key_hashes(terms)
    seeds, slots = divergence.perfect_hash(h)
    assert sorted(slots) == list(range(n))
    order = np.argsort(slots)
    table = divergence.Shards([("en", 1, 0, seeds.tobytes(), [terms[int(i)].as_py().decode() for i in order])])
    asked = pa.array([f"t{i}".encode() for i in range(2 * n)], pa.large_binary())
    found, at = table.slots("en", divergence.key_hashes(asked), np.arange(2 * n), asked)
    assert found[:n].all() and not found[n:].any() and at.tolist() == slots.tolist()
    assert not table.slots("de", divergence.key_hashes(asked), np.arange(2 * n), asked)[0].any()


def test_divergence_over_rounds_tiles_and_small_slots(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(" ".join(f"{'wé'[i % 2]}{chr(97 + int(x))}{chr(97 + int(y))}" for x, y in rng.integers(0, 9 + i % 5, (40, 2))), "en" if i % 4 else None, f"s{i % 11}" if i % 13 else None) for i in range(300)]
    rows += [(None, "xx", "a"), ("", "xx", "b"), ("rare", "en", "lonely"), ("9 8 7", None, "numbers")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({c: F.lit(1) for c in [*CLASHES[:-3], "_lang", "_source", "value", "item"]})
    shards, recount = divergence.perfect_shards, divergence.recount
    monkeypatch.setattr(divergence, "perfect_shards", lambda kept: shards(kept, shard_terms=16))
    monkeypatch.setattr(divergence, "recount", lambda docs, of: recount(docs, of, round_bytes=900, most_slots=40))
    got = sorted(map(tuple, divergence.source_divergence(df, least_docs=5, top=6, tile=3).collect()))
    assert got == plain_divergence(rows, 5, 6)


def test_divergence_of_odd_and_empty_tables(spark, odd):
    rows = [tuple(r) for r in odd.select("text", "lang", "source").collect()]
    assert sorted(map(tuple, divergence.source_divergence(odd, least_docs=2).collect())) == plain_divergence(rows, 2, 50)
    assert divergence.source_divergence(odd.limit(0)).collect() == []


# ---- ranked search


def plain_ranking(docs, items, k):
    terms = [Counter(re.findall(LETTERS_AND_DIGITS, lower(t))) for _, t in docs]
    n, total, df = sum(map(bool, terms)), sum(sum(c.values()) for c in terms), Counter(t for c in terms for t in c)
    out = []
    for item, text in items:
        asked, scores = Counter(re.findall(LETTERS_AND_DIGITS, lower(text))), []
        for (i, _), c in zip(docs, terms, strict=True):
            if c and i is not None:
                m = 75 + 25 * sum(c.values()) * n // total
                s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t, r in asked.items() if c[t])
                if s > 0:
                    scores.append((-s, i))
        out += [(item, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def ranked(docs, items, **more):
    return sorted(map(tuple, lexical.ranked_documents(docs, items, **more).collect()), key=repr)


def test_ranking_of_odd_rows_over_blocks(spark, odd):
    items = [(1, "a shared LINE with several words"), (1, "a shared LINE with several words"), (1, "word5 word6"), (2, None), (3, "nothing of it zzz"), (4, "single"), (None, "é9 more of it word7 word7")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in ["_item", "_term", "rank", "doc_id"]})
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    for more in ({}, {"block_bytes": 200, "seed_share": 1}):
        assert ranked(odd, table, k=3, **more) == plain_ranking(docs, items, 3)
    assert ranked(odd.limit(0), table) == [] and ranked(odd, table.limit(0)) == []


def test_pruned_leaves_hold_no_result(spark):
    rng = np.random.default_rng(2)
    docs = [(i, " ".join(f"{'abc'[i % 3]}{int(x)}" for x in rng.zipf(1.4, 30) % 400)) for i in range(1500)]
    docs += [(2000 + i, "b1 b2 b3 b4") for i in range(700)]
    items = [(i, " ".join(f"{'abc'[i % 3]}{int(x)}" for x in rng.zipf(1.4, 12) % 400)) for i in range(40)]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert ranked(a, b, k=5) == plain_ranking(docs, items, 5)


def test_bounds_are_above_every_score_and_prune():
    rng = np.random.default_rng(4)
    def rows(n, topic):
        lists = [np.unique(rng.integers(0, 30, 8) + 40 * (topic(i))) for i in range(n)]
        return lexical.Sparse(np.concatenate([[0], np.cumsum([len(x) for x in lists])]), np.concatenate(lists), rng.integers(1, 1000, sum(map(len, lists))).astype(float))
    docs, items = rows(2000, lambda i: i % 10), rows(40, lambda i: i % 4)
    dense = lambda s: np.array([np.bincount(s.codes[a:b], s.values[a:b], 400) for a, b in zip(s.cuts[:-1], s.cuts[1:], strict=True)])
    scores = dense(docs) @ dense(items).T
    tree = lexical.Items(items, 400, 5, np.zeros(40, np.int64))
    visited, real = [], tree.open_leaves
    tree.open_leaves = lambda *a: visited.append(x := real(*a)) or x
    tree.search(docs, np.arange(2000), leaf=16)
    for at, i in enumerate(tree.order):
        want = sorted(((-int(s), d) for d, s in enumerate(scores[:, i]) if s > 0))[:5]
        assert list(zip((-tree.scores[at]).tolist(), tree.docs[at].tolist(), strict=True)) == want
    assert sum(map(len, visited)) < 0.6 * 125 * 5  # of the pairs of leaves
