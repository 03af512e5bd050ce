from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import SMALL

from tradewake.llm import registry, whitening


def expected(vectors, components=4):
    """Plain version: every step in Python integers, except for the eigendecomposition."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, width = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(width)]
    centred = [[n * x[d] - sums[d] for d in range(width)] for x in fit]
    cov = np.array([[sum(r[a] * r[b] for r in centred) / n ** 3 for b in range(width)]
                    for a in range(width)])
    variance, axes = np.linalg.eigh(cov)
    out = []
    for vec_id, x in kept:
        deviation = [n * c - s for c, s in zip(x, sums, strict=True)]
        for k in range(min(components, width)):
            axis = axes[:, -1 - k]
            out.append((vec_id, k + 1, n, sum(d * d for d in deviation),
                        abs(float(np.dot(np.array(deviation, float) / n, axis)) / math.sqrt(variance[-1 - k])),
                        variance[-1 - k] / np.trace(cov)))
    return sorted(out, key=str)


def check(frame, vectors):
    found = frame.collect()
    wanted = expected(vectors)
    ours = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"])
                   for r in found), key=str)
    assert [r[:4] for r in ours] == [r[:4] for r in wanted]
    assert np.allclose([r[4:] for r in ours], [r[4:] for r in wanted], rtol=1e-6, atol=1e-6)
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-6


def test_query_matches_plain_version(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    check(registry.queries()["op13_embedding_whitening"](spark, SMALL),
          [(r["vec_id"], r["embedding"]) for r in rows])


def frame_of(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, n int, component string, x int")


def test_odd_rows(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [float(c) for c in draw.normal(0, 1, 5)]) for i in range(40)]
    rows += [(40, rows[3][1]), (3, rows[3][1]), (None, rows[4][1]), (50, [-0.0, 0.0, 1.0, -1.0, 1e-9])]
    rows += [(41, [c + 1e-12 for c in rows[5][1]])]
    odd = [(60, None), (61, [1.0, None, 0.0, 0.0, 0.0]), (62, [float("nan")] * 5),
           (63, [0.0, float("-inf"), 0.0, 0.0, 0.0])]
    other = [(70, []), (71, [1.0, 2.0]), (72, [0.0] * 7)]
    clash = (1, "clash", 2)
    check(whitening.whiten(frame_of(spark, [(*r, *clash) for r in rows + odd + other])), rows)


def test_wide_and_far_numbers_are_exact(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(int(c)) for c in draw.integers(-2 ** 40, 2 ** 40, 3)]) for i in range(30)]
    found = whitening.whiten(frame_of(spark, [(*r, 1, "", 2) for r in rows])).collect()
    wanted = {(r[0], r[1]): r[3] for r in expected(rows)}
    for r in found:
        exact = wanted[r["vec_id"], r["component"]]
        assert r["deviation"] == (exact if exact < 2 ** 63 else None)
    ends = [(1, [1e308, -1e308]), (2, [-1e308, 1.0]), (3, [0.5, 3.0])]
    assert len(whitening.whiten(frame_of(spark, [(*r, 1, "", 2) for r in ends])).collect()) == 6


def test_vectors_that_do_not_vary(spark):
    one = whitening.whiten(frame_of(spark, [(1, [1.0, 2.0], 1, "", 2)] * 3)).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == \
        [(1, 0, None, 0.0, None)] * 6
    line = [(i, [float(i), 2.0 * i, 7.0], 1, "", 2) for i in range(10)]
    found = whitening.whiten(frame_of(spark, line)).collect()
    assert {r["component"]: r["whitened"] is None for r in found} == {1: False, 2: True, 3: True}
    assert all(r["explained"] == pytest.approx(float(r["component"] == 1)) for r in found)
    assert found[0]["identity_error"] < 1e-9


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1, "", 2)], [(1, [], 1, "", 2)]):
        frame = whitening.whiten(frame_of(spark, rows))
        assert frame.collect() == []
        assert frame.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                                     "identity_error"]


@pytest.mark.parametrize(("low", "high", "rows"), [(-3, 3, 1), (-1000, 1000, 63), (0, 1, 130),
                                                   (-2 ** 62, 2 ** 62, 20), (5, 6, 64)])
def test_bit_planes_like_plain_products(low, high, rows):
    x = np.random.default_rng(rows).integers(low, high, (rows, 6))
    x[:, 2] = 5
    sums, products = whitening.cross_products(x)
    plain = x.astype(object)
    assert sums.tolist() == plain.sum(axis=0).tolist()
    assert products.tolist() == np.triu(plain.T @ plain).tolist()


def test_pieces_add_up():
    for value in (0, 1, -1, 2 ** 31, -2 ** 31, 2 ** 32, 10 ** 40, -10 ** 40 + 7):
        assert sum(part << (32 * place) for place, part in whitening.pieces(value)) == value
