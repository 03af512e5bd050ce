from __future__ import annotations

import re

import brute
import pytest
from conftest import ODD, SMALL, ordered, pairs
from pyspark.sql import functions as F

import compare
from tradewake.llm import exact_dedup, line_dedup, registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    sql = compare.connect(SMALL).execute(registry.oracle_sql()[name]).df()
    assert compare.differences(registry.queries()[name](spark, SMALL).toPandas(), sql) == ""


def groups_of(docs):
    groups = {}
    for doc_id, text in docs:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", text or ""), []).append((doc_id, text))
    return groups


def test_odd_rows_are_grouped_by_text_without_white_space(odd):
    rows = exact_dedup.exact_groups(odd).collect()
    groups = groups_of([(r[0], r[1]) for r in ODD])
    assert sorted(r["group_size"] for r in rows) == \
        sorted(len(g) for g in groups.values() for _ in g)
    assert sum(r["kept"] for r in rows) == len(groups)
    assert {r["keep_id"] for r in rows if r["doc_id"] in (5, 6)} == {5}


def test_weak_hash_changes_nothing(odd):
    def weak(text):
        return F.unhex(F.substring(F.md5(text.cast("binary")), 1, 2))
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    assert ordered(exact_dedup.exact_groups(odd, weak).select(columns).collect()) == \
        ordered(exact_dedup.exact_groups(odd).select(columns).collect())


def test_copies_are_dropped_with_all_columns_kept(odd):
    left = exact_dedup.drop_exact_copies(odd)
    assert left.columns == odd.columns
    assert len(left.collect()) == len(groups_of([(r[0], r[1]) for r in ODD]))


@pytest.mark.parametrize("least", [2, 3, 10])
def test_lines_like_brute_force(small, odd, least):
    for docs in (small, odd):
        found = line_dedup.drop_frequent_lines(docs, least).select(
            "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)).collect()
        assert ordered(found) == ordered(brute.line_dedup(pairs(docs), least))


def test_a_text_of_very_many_lines(spark):
    """Takes time in proportion to the lines; with a square of them it would not end."""
    lines = [f"line {i}" if i % 3 else "the same" for i in range(200_000)]
    docs = spark.createDataFrame([(0, "\n".join(lines))] + [(i, "the same") for i in range(1, 10)],
                                 "doc_id long, text string")
    found = line_dedup.drop_frequent_lines(docs).filter("doc_id = 0").collect()[0]
    assert found["kept"] == "\n".join(line for line in lines if line != "the same")
    assert (found["n_lines"], found["n_dropped"]) == (200_000, 66_667)


def test_empty_tables(none):
    assert exact_dedup.exact_groups(none).collect() == []
    assert exact_dedup.drop_exact_copies(none).collect() == []
    assert line_dedup.drop_frequent_lines(none).collect() == []
