"""The pipeline's stages, each against a plain version of what it does with its own input."""

from __future__ import annotations

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import SMALL


def test_stages_keep_their_contracts(spark, documents, tmp_path):
    taken, docs = [], documents
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        taken.append({r["doc_id"]: r for r in docs.collect()})
        if i < 4:
            assert docs.columns == documents.columns
    start = {r["doc_id"]: r for r in documents.collect()}
    good, lines, single, clean, mixed = taken
    assert all(good[i] == start[i] for i in good) and len(good) > 0.7 * len(start)
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert all(i in good for i, q in quality.items() if q == 1)
    order = sorted(good)
    plain = brute.without_lines([good[i]["text"] for i in order])
    assert [lines[i]["text"] for i in order] == [p[2] for p in plain] and all(len(r["text"]) == r["n_chars"] for r in lines.values())
    classes = brute.near_classes([(i, r["text"]) for i, r in lines.items()])
    assert set(single) == {c for c, _, _ in classes.values()}
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert set(clean) <= set(single) and not any(x in r["text"] for r in clean.values() for x in items)
    assert set(mixed) == set(clean) and all(r["taken"] <= 3 * r["size"] for r in mixed.values())
    again = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert again == mixed


def test_there_are_five_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "mixing"]


def test_stages_on_odd_rows_and_without_rows(spark, odd):
    given = [r["text"] for r in odd.collect()]
    none = odd.limit(0)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        rows = stage(spark, odd, SMALL).collect()
        if name == "line_dedup":
            # no line is in ten of these documents
            assert sorted(r["text"] for r in rows) == sorted(t or "" for t in given)
        elif name == "near_duplicates":
            # repeated texts leave one, texts without words stay
            assert sorted(r["text"] for r in rows if (r["text"] or "").split()) == sorted({t for t in given if (t or "").split()})
            assert sum(not (r["text"] or "").split() for r in rows) == sum(not (t or "").split() for t in given)
        elif name in ("decontamination", "mixing"):
            assert len(rows) == len(given)
        else:
            assert all(r["text"] in given for r in rows)
        if i < 4:
            assert not rows or rows[0].asDict().keys() == set(corpus_pipeline.COLUMNS)
        assert stage(spark, none, SMALL).count() == 0
