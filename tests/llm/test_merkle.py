from __future__ import annotations

import hashlib
import zlib

import pytest
from conftest import ordered

from tradewake.llm import merkle

FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row[0], row[1], row[2], row[3], text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, arity):
    """Root, and for every node the others of its runs as (left, right), level by level."""
    own, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        runs = [nodes[i:i + arity] for i in range(0, len(nodes), arity)]
        for at, path in enumerate(paths):
            run, slot = runs[own[at] // arity], own[at] % arity
            path.append(("".join(run[:slot]), "".join(run[slot + 1:])))
            own[at] //= arity
        nodes = [h(*run) for run in runs]
    return nodes[0], paths


def plain(rows, arity=3):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
              for s in sources]
    made = [tree([leaf(r, r[4]) for r in group], arity) for group in groups]
    root, tops = tree([subroot for subroot, _ in made], arity)
    out = []
    for group, (subroot, paths), top in zip(groups, made, tops, strict=True):
        for row, path in zip(group, paths, strict=True):
            text = row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            node = leaf(row, text)
            for left, right in path + top:
                node = h(left, node, right)
            out.append((row[0], leaf(row, row[4]), subroot, root,
                        h(*(a + b for a, b in path + top)), node, node == root))
    return out


def rows_of(sizes):
    rows = []
    for source, size in sizes:
        rows += [(len(rows) * 7 % 1009, source, "en", i, f"text {i}\nof {source}") for i in range(size)]
    return rows


@pytest.mark.parametrize("arity", [2, 3, 4])
def test_trees_of_many_sizes(spark, arity):
    rows = rows_of([("a", 1), ("b", 2), ("c", 3), ("d", 4), (None, 10), ("", 27), ("sé", 28), ("z", 82)])
    found = merkle.manifest(spark.createDataFrame(rows, FIELDS), arity).collect()
    assert ordered(found) == ordered(plain(rows, arity))


@pytest.mark.parametrize("size", [1, 2, 3, 9, 10])
def test_one_source(spark, size):
    rows = rows_of([("only", size)])
    assert ordered(merkle.manifest(spark.createDataFrame(rows, FIELDS)).collect()) == ordered(plain(rows))


def test_every_source_a_row(spark):
    rows = rows_of([(f"s{i}", 1) for i in range(30)])
    assert ordered(merkle.manifest(spark.createDataFrame(rows, FIELDS)).collect()) == ordered(plain(rows))


def test_odd_rows(spark, odd):
    """Nulls in every field, empty and long texts, equal ids, equal rows, clashing columns."""
    frame = odd.selectExpr("*", "length(text) AS n_chars", "'clash' AS tree", "1 AS at", "2 AS place", "3 AS part")
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in frame.collect()]
    rows += [(5, None, None, None, None)] * 2 + [(None,) * 5]
    more = spark.createDataFrame(rows[-3:], FIELDS)
    found = merkle.manifest(frame.unionByName(more, allowMissingColumns=True)).collect()
    assert ordered(found) == ordered(plain(rows))


def test_empty_table(none):
    frame = merkle.manifest(none.selectExpr("*", "1 AS n_chars"))
    assert frame.collect() == []
    assert frame.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_leaves_are_numbered_over_partitions(spark):
    rows = spark.range(5000).selectExpr("if(id % 3 = 0, 'hot', concat('t', id % 7)) AS tree", "-id DIV 4 AS v")
    found = merkle.numbered(rows, "tree", ["v"]).toPandas().sort_values(["tree", "at"])
    for _, own in found.groupby("tree"):
        assert own["at"].tolist() == list(range(len(own))) and set(own["n"]) == {len(own)}
        assert own["v"].is_monotonic_increasing


