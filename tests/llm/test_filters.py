"""Mixing, quality, line deduplication and scores against plain versions, and on odd input."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewarden.llm import linededup, lmscore, mixing, quality
from scorewarden.llm.queries import QUERIES, SQL, learnable
from tests.llm import brute
from tests.llm.conftest import CLASHES, SMALL
from tests.oracle import compare


def test_mix_meets_the_targets_and_repeats_itself(spark, documents):
    rows = mixing.mix_sources(documents).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix_sources(documents.repartition(5)).collect()))
    source = {r["doc_id"]: (r["source"], len(brute.words(r["text"]))) for r in documents.collect()}
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r["size"] == source[r["doc_id"]][1] and r["taken"] == r["size"] * r["times"] and r["times"] <= 3
        sizes[source[r["doc_id"]][0]] += r["size"]
        taken[source[r["doc_id"]][0]] += r["taken"]
    want = brute.targets(dict(sizes))
    for r in rows:
        s = source[r["doc_id"]][0]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_large_budgets_draw_on_every_length():
    sizes, counts = np.arange(1, 2001), np.full(2000, 40)
    got = mixing.fitted_copies(sizes, counts, 0.4 * (sizes * counts).sum() + 7, 3, 1 << 12)
    assert int((got * sizes).sum()) == int(0.4 * (sizes * counts).sum() + 7)
    assert (np.abs(got - 16) <= 1).mean() > 0.95


def test_resharing_stops_at_three_times_a_source(spark):
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 1), ("b", 90), ("c", 5), (None, 4)])]
    got = {r["doc_id"]: r["target"] for r in mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    want = brute.targets({"a": 1, "b": 90, "c": 5, None: 4})
    assert got == pytest.approx({0: want["a"], 1: want["b"], 2: want["c"], 3: want[None]})


@pytest.mark.parametrize("sizes, counts, budget", [([3, 5, 7], [4, 4, 4], 31.9), ([4, 6], [10, 10], 33.0), ([1000], [3], 500.0), ([2, 9, 11], [50, 3, 9], 400.5), ([5], [2], 0.0)])
def test_fitted_copies_is_the_best_reachable_sum(sizes, counts, budget):
    sizes, counts = np.array(sizes), np.array(counts)
    got = mixing.fitted_copies(sizes, counts, budget, 3, 1 << 16)
    assert ((got >= 0) & (got <= 3 * counts)).all()
    reach = {0}
    for s, c in zip(sizes, counts, strict=True):
        reach = {r + s * n for r in reach for n in range(3 * int(c) + 1) if r + s * n <= budget}
    assert int((got * sizes).sum()) == max(reach)



def test_mix_of_odd_rows(spark, odd):
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == odd.count() and all(r["times"] * r["size"] == r["taken"] for r in rows)
    assert mixing.mix_sources(odd.limit(0)).count() == 0
    assert {r["target"] for r in mixing.mix_sources(odd.where("coalesce(text, '') = ''")).collect()} == {0.0}


def test_quality_scores_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op2_quality"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([[a > b for b in bad] for a in good]) > 0.98
    assert np.mean([s >= 0.7 for s in good]) > 0.98


def test_quality_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(4, 1), (4, 1), (6, 0), (9, 1), (None, 1), (5, None)], "doc_id long, quality int")
    weights = quality.fit(odd, labels, bits=10)
    rows = quality.score(odd, weights).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if not (r["text"] or "").strip("\x0b \t\n")} == {rows[0]["score"]}
    assert set(quality.score(odd, weights).columns) == set(odd.columns)
    assert quality.score(odd.limit(0), weights).count() == 0 and quality.fit(odd.limit(0), labels.limit(0), bits=4).sum() == 0


def test_held_out_rows_are_never_learned_from(spark):
    labels = spark.range(200).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    import zlib
    assert {r[0] for r in learnable(labels).select("doc_id").collect()} == {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_lines_against_sql(spark, con):
    assert compare(spark, con, "op5", QUERIES["op5_line_dedup"], SQL["op5_line_dedup"], SMALL) is None


def test_lines_of_odd_rows(spark, odd):
    many = odd.unionByName(odd).unionByName(odd)
    got = linededup.drop_frequent_lines(many, least_documents=7, batches=3, fanout=2)
    assert got.columns == [*many.columns, "_n_lines", "_n_dropped"]
    rows = many.collect()
    want = Counter(brute.without_lines([r["text"] for r in rows], 7))
    assert Counter((r["_n_lines"], r["_n_dropped"], r["text"]) for r in got.collect()) == want
    assert sum(n for (_, dropped, _), n in want.items() if dropped) == 9
    assert {tuple(r[c] for c in CLASHES) for r in got.collect()} == {tuple(range(len(CLASHES)))}
    assert linededup.drop_frequent_lines(odd.limit(0)).count() == 0


def test_runs_are_compacted_and_keep_their_counts(spark):
    runs = linededup.LineRuns(spark, least_documents=5, fanout=2)
    for i in range(5):
        runs.add(spark.range(10).select(F.col("id").alias("_a"), F.lit(0).cast("long").alias("_b"), F.lit(1 + i % 2).cast("long").alias("documents")))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {r["documents"] for r in runs.counts().collect()} == {6} and runs.frequent().count() == 10
    runs.drop()
    assert not spark.catalog.databaseExists(runs.database)


def test_a_batch_meets_the_runs_without_moving_or_sorting_them(spark):
    runs = linededup.LineRuns(spark, least_documents=3, fanout=3)
    for i in range(4):
        runs.add(spark.range(i, 40).select(F.col("id").alias("_a"), F.col("id").alias("_b"), F.lit(2).cast("long").alias("documents")))
    assert [len(level) for level in runs.levels] == [1, 1]
    batch = spark.range(60).select(F.col("id").alias("_a"), F.col("id").alias("_b"), F.lit(1).cast("long").alias("documents"))
    with linededup._sorted_scans(spark):
        unknown = runs.unknown(batch)
        plan = unknown._jdf.queryExecution().executedPlan().toString()
        # one exchange and one sort, both of the batch
        assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hash") == 1 and plan.count("Sort [") == 1, plan
        assert {r["_a"] for r in unknown.collect()} == {0, *range(40, 60)}
    assert {r["_a"]: r["documents"] for r in runs.counts().collect()}[39] == 6
    runs.drop()


def test_copies_of_a_text_and_long_texts_lose_their_lines(spark):
    long = "\n".join(f"line {i % 700}" if i % 3 else "Shared " for i in range(60000))
    texts = ["shared\nown"] * 40 + [long, long + "\nend", " SHARED"] + [f"\n{i}\nshared" for i in range(20)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = linededup.drop_frequent_lines(docs, least_documents=3).collect()
    assert Counter((r["_n_lines"], r["_n_dropped"], r["text"]) for r in got) == Counter(brute.without_lines(texts, 3))


@pytest.mark.parametrize("vocabulary_size", [50, None])
def test_cross_entropy_difference_against_a_plain_model(spark, vocabulary_size):
    texts = ["the cat sat on the mat", "The dog sat", "", None, "cat cat dog", "on-mat the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    target = spark.createDataFrame([(0,), (4,), (4,), (None,)], "doc_id long")
    rows = {r["doc_id"]: r for r in lmscore.cross_entropy_difference(docs, target, vocabulary_size=vocabulary_size, prior=2.0).collect()}
    split = [[w for w in "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()] for t in texts]
    names = sorted({w for t in split for w in t})
    size = len(names) + 2  # and the unknown word and the start mark

    def model(members, scale=1.0):
        pair, word, before = (defaultdict(float) for _ in range(3))
        for m in members:
            for a, b in zip(["^", *split[m]], split[m]):
                pair[a, b] += scale
                word[b] += scale
                before[a] += scale
        total = sum(word.values())
        return lambda a, b: -math.log2((pair[a, b] + 2.0 * (word[b] + 1) / (total + size)) / (before[a] + 2.0))
    n_target, n_all = (sum(len(split[m]) for m in ms) for ms in ([0, 4], range(6)))
    near, far = model([0, 4]), model(range(6), n_target / n_all)
    for i, t in enumerate(split):
        assert rows[i]["n_words"] == len(t)
        for name, loss in (("target_loss", near), ("background_loss", far)):
            want = sum(loss(a, b) for a, b in zip(["^", *t], t)) / max(1, len(t))
            assert rows[i][name] == pytest.approx(want, abs=1e-5)
        assert rows[i]["difference"] == pytest.approx(rows[i]["target_loss"] - rows[i]["background_loss"])


def test_cross_entropy_of_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long")
    rows = lmscore.cross_entropy_difference(odd, none, vocabulary_size=20).collect()
    assert len(rows) == odd.count() and all(r["difference"] == 0 for r in rows if not r["n_words"])
    assert lmscore.cross_entropy_difference(odd.limit(0), none).count() == 0


def test_losses_tell_rare_words_apart(spark):
    common = " ".join(f"word{i}" for i in range(1100))
    texts = [common, common, "word1 zebra word2", "word1 okapi word2", "word1 zebra word2"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in lmscore.cross_entropy_difference(docs, spark.createDataFrame([(0,), (2,)], "doc_id long")).collect()}
    assert rows[2]["difference"] == rows[4]["difference"] < rows[3]["difference"] - 0.005


def test_losses_do_not_depend_on_chunks(spark, documents, monkeypatch):
    target = documents.where("doc_id % 3 = 0").select("doc_id")
    got = [lmscore.cross_entropy_difference(documents.repartition(3), target)]
    monkeypatch.setattr(lmscore, "LEAST_BUCKETS", 256)
    got.append(lmscore.cross_entropy_difference(documents.repartition(7), target))
    one, two = ({r["doc_id"]: r["difference"] for r in df.collect()} for df in got)
    assert one == pytest.approx(two)


def test_large_sources_of_few_lengths_are_fitted_exactly():
    for scale in (1, 10_000):
        assert mixing.fitted_copies(np.array([4, 5]) * scale, np.array([1, 1]), 12.0 * scale, 3, 1 << 16).tolist() == [3, 0]
    # 200 documents of each length: only some are given back
    sizes, counts = np.array([40_000, 50_000]), np.array([200, 200])
    got = mixing.fitted_copies(sizes, counts, 18_030_000.0, 3, 1 << 16)
    assert int((got * sizes).sum()) == 18_030_000 and ((got >= 0) & (got <= 3 * counts)).all()
