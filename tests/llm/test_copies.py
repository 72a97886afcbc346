"""Near copies, repeated strings and fingerprints against plain versions, and on odd input."""

from __future__ import annotations

from collections import Counter
from random import Random

import pytest
from pyspark.sql import functions as F

from scorewarden.llm import fingerprints, graph, neardup, substrings
from scorewarden.llm.queries import QUERIES, SQL
from tests.llm import brute
from tests.llm.conftest import SMALL
from tests.oracle import compare


def found_classes(df):
    return {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in df.collect()}


def test_near_copies_of_the_documents(spark, texts):
    assert found_classes(QUERIES["op9_jaccard_join"](spark, SMALL)) == brute.near_classes(texts)


def test_near_copies_against_sql(spark, con):
    assert compare(spark, con, "op9", QUERIES["op9_jaccard_join"], SQL["op9_jaccard_join"], SMALL) is None


def edited(draw, words, n):
    out = list(words)
    for _ in range(n):
        out[draw.randrange(len(out))] = f"new{draw.randrange(10 ** 6)}"
    return " ".join(out)


@pytest.mark.parametrize("block", [8, 256])
def test_large_groups_of_near_copies_lose_no_link(spark, block):
    """Near copies around the threshold and of several sizes, worked through in many small blocks or in one."""
    draw = Random(5)
    rows = []
    for g, (members, length) in enumerate([(60, 120), (25, 40), (3, 300)]):
        base = [f"w{g}x{draw.randrange(10 ** 6)}" for _ in range(length)]
        for _ in range(members):
            rows.append(edited(draw, base[: length - draw.randrange(length // 8)], draw.randrange(3)))
    rows += [rows[0], rows[0], "some quite unrelated text that stands here all alone", "", None]
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.near_classes(rows)
    assert found_classes(neardup.near_duplicates(docs, block=block)) == want
    assert sum(links for _, links, _ in want.values()) > 500
    kept = [r["doc_id"] for r in neardup.one_of_each(docs, block=block).collect()]
    assert sorted(kept) == sorted({c for c, _, _ in want.values()})


def test_near_copies_of_odd_rows(spark, odd):
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["class_id"] == 1 and by_id[2]["class_id"] == 2 and by_id[9]["class_id"] == by_id[10]["class_id"] == 9
    assert by_id[4]["n_copies"] == 2 and by_id[9]["n_copies"] == 2
    kept = neardup.one_of_each(odd)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, 3, None, None, 4, 5, 6, 7, 8, 9, 11])
    assert neardup.near_duplicates(odd.limit(0)).count() == 0 and neardup.one_of_each(odd.limit(0)).count() == 0


def test_unlikely_pairs_are_dropped_early():
    plan = neardup.least_matches(128, 0.8, 1e-6)
    assert [n for n, _ in plan] == [32, 64, 96, 128]
    assert all(0.3 * n < m < 0.75 * n for n, m in plan)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, None)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


def kept_strings(df):
    return Counter((r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["_kept"])) for r in df.collect())


def test_repeated_strings_of_the_documents(spark, texts):
    rows = {r["doc_id"]: tuple(r[1:]) for r in QUERIES["op8_repeated_strings"](spark, SMALL).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    want = brute.without_repeats([t for _, t in texts], 400)
    assert rows == {i: (*w[:3], brute.sha(w[3])) for (i, _), w in zip(texts, want, strict=True)}
    assert sum(w[1] for w in want) > 0


@pytest.mark.parametrize("seed", range(4))
def test_repeated_strings_of_patchworks(spark, seed):
    """Texts pieced together from few fragments, with repeats inside a text, periods, edits and whole copies."""
    draw = Random(seed)
    letters = "abcdéß \n"
    pieces = ["".join(draw.choice(letters) for _ in range(draw.randrange(5, 90))) for _ in range(8)] + ["ab" * 40, "x" * 70]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randrange(6))) for _ in range(40)]
    texts += [texts[3], texts[5][:-1] + "!", None, "", "short"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # a small window, so that every pass has work: 8-byte grams and cells of 4 windows
    spans = substrings.repeated_spans(docs, length=40, gram=8, cell=4)
    real, substrings.repeated_spans = substrings.repeated_spans, lambda d, **k: spans
    try:
        got = kept_strings(substrings.drop_repeats(docs, length=40))
    finally:
        substrings.repeated_spans = real
    assert got == Counter(brute.without_repeats(texts, 40))


def test_repeated_strings_of_odd_rows(spark, odd):
    assert kept_strings(substrings.drop_repeats(odd)) == Counter(brute.without_repeats([r["text"] for r in odd.collect()], 400))
    assert substrings.drop_repeats(odd.limit(0)).count() == 0


def test_texts_are_joined_where_their_table_lies_and_the_table_is_removed(spark):
    """Copies are one row, joins by key move only the other side, and a failure leaves no table behind."""
    docs = spark.createDataFrame([(1, "abc"), (2, "abc"), (None, "de"), (4, "é" * 500)], "_key long, _text string")
    docs = docs.select("*", *substrings.text_key(F.col("_text")))
    with substrings.text_table(docs) as stored:
        assert sorted(r["_copies"] for r in stored.collect()) == [1, 1, 2]
        other = docs.select("_k1", "_k2", F.lit(1).alias("one")).hint("merge")
        joined = stored.join(other, ["_k1", "_k2"])
        assert joined.count() == 4
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    with pytest.raises(KeyError), substrings.text_table(docs):
        raise KeyError
    assert not [r[0] for r in spark.sql("SHOW DATABASES").collect() if r[0].startswith("texts_")]


def test_copies_of_a_hot_text_leave_whole_with_their_own_keys(spark):
    rows = [(i, "hot " * 120) for i in range(60)] + [(100, "hot " * 99 + "end"), (101, "x" * 399), (None, "hot " * 120), (102, "y" * 400)]
    got = {(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in substrings.drop_repeats(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {*((i, 480, 480, 1) for i in (*range(60), None)), (100, 399, 0, 0), (101, 399, 0, 0), (102, 400, 0, 0)}


def fingerprinted(df):
    return sorted((r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in df.collect())


def expected(texts):
    """Texts in the order in which they follow each other."""
    out = []
    for here, after in zip(texts, [*texts[1:], *texts[:1]], strict=True):
        cut = len(here) // 3
        new = here[: len(here) - cut] + after[:cut]
        out.append((len(here), brute.sha(new), round(brute.lines_jaccard(here, new), 9), round(brute.lines_jaccard(here, after), 9)))
    return sorted(out)


def test_fingerprints_of_the_documents(spark, texts):
    assert fingerprinted(QUERIES["op7_fingerprints"](spark, SMALL)) == expected([t or "" for _, t in reversed(texts)])


def test_equal_texts_share_fingerprints_and_long_ones_are_retried(spark):
    draw = Random(1)
    long = ["\n".join(f"line {draw.randrange(700)}" for _ in range(n)) for n in (30, 150, 900, 2500)]
    rows = list(enumerate([*long, long[0], "", None, "one line"]))
    got = fingerprints.version_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    assert fingerprinted(got) == expected([t or "" for _, t in reversed(rows)])
    prints = {r["doc_id"]: r["fingerprint"] for r in got.collect()}
    assert prints[0] == prints[4] and prints[5] == prints[6] and len(set(prints.values())) == 6


def test_fingerprints_of_odd_rows(spark, odd):
    # ids 4 and 9 to 10 repeat texts; rows without an id come last, by a hash of their text
    got = fingerprints.version_fingerprints(odd).collect()
    assert len(got) == odd.count() and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    known = odd.where("doc_id is not null").orderBy(F.desc("doc_id")).collect()
    assert fingerprinted(fingerprints.version_fingerprints(odd.where("doc_id is not null"))) == expected([r["text"] or "" for r in known])
    assert fingerprints.version_fingerprints(odd.limit(0)).count() == 0
    one = fingerprints.version_fingerprints(odd.where("doc_id = 11")).first()
    assert one["near_next"] == 1.0


def test_differences_beyond_the_widest_table_are_counted_by_digest(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "_FIELD", 4)
    rows = [(1, 0, list(range(1, 120)), list(range(60, 150))), (2, 0, [7, 8], [8, 9])]
    pairs = spark.createDataFrame(rows, "_id long, _side int, _a array<long>, _b array<long>")
    got = {r["_id"]: r["_differing"] for r in fingerprints.large_differences(pairs).collect()}
    assert got == {i: len(set(a) ^ set(b)) for i, _, a, b in rows}


def test_repeats_are_found_in_small_batches_of_texts(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    seen, before, plain = [], spark.conf.get(key), substrings.settled
    monkeypatch.setattr(substrings, "settled", lambda df: seen.append(int(spark.conf.get(key))) or plain(df))
    docs = spark.createDataFrame([(i, f"{i % 3} " * 300) for i in range(6)], "doc_id long, text string")
    found = substrings.drop_repeats(docs).collect()
    assert len(found) == 6 and all(r["n_removed"] == r["n_bytes"] for r in found)
    assert len(seen) >= 2 and max(seen) <= substrings.BATCH_TEXTS and spark.conf.get(key) == before
