"""The pipeline's stages against plain versions, and on odd tables."""

from __future__ import annotations

import brute
import corpus_pipeline
import pytest
from conftest import ODD, ordered
from test_exact_and_lines import groups_of
from test_texts import digests

from tradewake.llm import quality

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's result, written and read again as the next one's input."""
    made = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{made}/{name}")
        docs = spark.read.parquet(f"{made}/{name}")
        tables.append(docs)
    return tables


def rows(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def test_stages_like_plain_versions(spark, stages):
    good, once, distinct, clean, tokens = stages[1:]
    for before, after in zip(stages[:4], stages[1:5], strict=True):
        assert after.columns == before.columns
        assert set(rows(after)) < set(rows(before))
    scored = quality.classify(stages[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert {r["doc_id"] for r in scored.filter("predicted = 1").collect()} == {d for d, _ in rows(good)}

    best = {min(g, key=lambda r: (-len(r[1] or ""), r[0]))[0] for g in groups_of(rows(good)).values()}
    assert best == {d for d, _ in rows(once)}

    near = brute.jaccard_components(rows(once), 5, 4, 5)
    assert {d for d, n, c in near if d == c or n == 0} == {d for d, _ in rows(distinct)}

    items = [tuple(r) for r in
             spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {r[0] for r in brute.contamination(rows(distinct), items) if r[5]}
    assert dirty and {d for d, _ in rows(distinct)} - dirty == {d for d, _ in rows(clean)}

    assert ordered(tokens.collect()) == ordered(digests(*r) for r in rows(clean))


def test_run_is_its_stages(spark, stages):
    assert ordered(corpus_pipeline.run(spark, FOLDER).collect()) == ordered(stages[-1].collect())


def test_stages_take_odd_and_empty_tables(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, docs, FOLDER)
            assert left.columns == docs.columns
            assert left.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()
    assert len(ODD) == odd.count()
