from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from conftest import ordered, pairs

from tradewake.llm import jaccard_join
from tradewake.llm.components import components


def components_of(docs, size, num, den, **more):
    return ordered(jaccard_join.jaccard_components(docs, size, num, den, **more)
                   .select("doc_id", "n_shingles", "component_id").collect())


@pytest.fixture(scope="module")
def near(spark):
    """Groups of near copies around the threshold, with a passage that all texts share."""
    draw = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    shared = draw.sample(words, 12)
    rows = []
    for group, size in enumerate((420, 40, 12, 5, 2)):
        base = draw.sample(words, 90 + 30 * group)
        for _ in range(size):
            text = list(base)
            for _ in range(draw.choice((0, 1, 1, 2, 2, 3, 4))):
                text[draw.randrange(len(text))] = draw.choice(words)
            rows.append(" ".join(text + shared))
    rows += [" ".join(draw.sample(words, draw.randrange(1, 60)) + shared) for _ in range(150)]
    draw.shuffle(rows)
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


@pytest.mark.parametrize("rule", [(3, 90, 100), (5, 4, 5), (2, 1, 2)])
def test_near_copies_like_brute_force(near, rule):
    assert components_of(near, *rule) == ordered(brute.jaccard_components(pairs(near), *rule))


def test_small_blocks_and_long_lists_change_nothing(near, monkeypatch):
    expected = components_of(near, 3, 90, 100)
    monkeypatch.setattr(jaccard_join, "BLOCK", 3000)
    assert components_of(near, 3, 90, 100) == expected


def test_sets_alone_in_their_piece_keep_their_links(near):
    """All lists cut, small groups too: most sets are the only one in a piece."""
    few = near.filter("doc_id % 3 = 0").unionByName(near.filter("doc_id % 3 = 1").selectExpr(
        "doc_id", "concat(text, ' ', doc_id) AS text"))
    assert components_of(near, 3, 90, 100, long_list=0) == \
        ordered(brute.jaccard_components(pairs(near), 3, 90, 100))
    assert components_of(few, 5, 4, 5, long_list=0) == ordered(brute.jaccard_components(pairs(few), 5, 4, 5))


def test_given_documents_like_brute_force(small):
    assert components_of(small, 3, 90, 100) == ordered(brute.jaccard_components(pairs(small), 3, 90, 100))


def test_odd_rows(odd, none):
    found = jaccard_join.jaccard_components(odd, 3, 90, 100).collect()
    assert len(found) == odd.count()
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[5]["component_id"] == by_id[6]["component_id"] == by_id[7]["component_id"] == 5
    assert by_id[2]["n_shingles"] == by_id[3]["n_shingles"] == 0 and by_id[3]["component_id"] == 3
    left = jaccard_join.drop_near_copies(odd, 3, 90, 100)
    assert left.columns == odd.columns
    kept = [r["doc_id"] for r in left.collect()]
    assert 5 in kept and 6 not in kept and 7 not in kept and kept.count(11) == 2
    assert components_of(none, 3, 90, 100) == []
    assert jaccard_join.drop_near_copies(none, 5, 4, 5).collect() == []


def test_derived_links_like_plain_counting():
    draw = np.random.default_rng(1)
    hub = np.arange(100, dtype=np.uint64)
    sets = []
    for _ in range(60):
        out = draw.choice(100, draw.integers(0, 9), replace=False)
        new = draw.integers(100, 130, draw.integers(0, 9)).astype(np.uint64)
        sets.append(np.unique(np.r_[np.delete(hub, out), new]))
    outer, members = sets[:20], sets

    def linked(a, b):
        return 10 * len(np.intersect1d(a, b)) >= 9 * len(np.union1d(a, b))

    def joined(pairs_):
        parent = list(range(80))
        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for i, j in pairs_:
            parent[root(i)] = root(20 + j)
        return [root(x) for x in range(80)]

    found = jaccard_join.derived_links(hub, outer, members, 9, 10)
    assert all(linked(outer[i], members[j]) for i, j in found)
    every = joined([(i, j) for i in range(20) for j in range(60) if linked(outer[i], members[j])])
    some = joined(found)
    assert len(set(zip(every, some, strict=True))) == len(set(every)) == len(set(some))


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 90)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r["node"], r["label"]) for r in found} == \
        {(i, 0) for i in range(41)} | {(100, 90), (95, 90), (90, 90)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_texts_of_classes_are_not_written(spark, monkeypatch):
    """They go through one exchange by set, whose files both sides of a comparison read."""
    draw = random.Random(14)
    texts = [[f"w{draw.randrange(500)}" for _ in range(60)] for _ in range(20)]
    rows = [(i, " ".join(t + [f"end{i % 2}"])) for i, t in enumerate(texts + texts)]
    names, stored = [], jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda frame, name: names.append((name, frame.columns)) or stored(frame, name))
    found = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {i: i % 20 for i in range(40)}
    assert not [name for name, columns in names if "text" in columns]
