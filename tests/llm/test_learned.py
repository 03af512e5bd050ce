from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import pytest
from conftest import ordered
from pyspark.sql import functions as F

from tradewake.llm import language_id, quality, registry

FOLDER = "/root/testdata/sf0.01"


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_language_of_held_out_documents(spark, documents):
    found = registry.queries()["op2_language_id"](spark, FOLDER).collect()
    truth = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    assert sorted(r["doc_id"] for r in found) == sorted(truth)
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in found)
    out = [r for r in found if r["held_out"] and truth[r["doc_id"]]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_uses_text_alone(documents):
    """Predictions do not change with labels that are held out, nor with ids of other rows."""
    changed = documents.withColumn("lang", F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, "xx").otherwise(F.col("lang")))
    columns = ["doc_id", "lang_pred", "score"]
    assert ordered(language_id.identify(changed).select(columns).collect()) == \
        ordered(language_id.identify(documents).select(columns).collect())


def test_language_of_odd_rows(spark, odd, none):
    found = language_id.identify(odd).collect()
    assert len(found) == odd.count()
    letterless = {1, 2, 3, 14}
    for r in found:
        if r["doc_id"] in letterless:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in ("en", "de", "fr") and r["score"] > 0
    assert language_id.identify(none).collect() == []
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in language_id.identify(unlabelled).collect()} == {("und", 0.0)}


def test_every_language_is_a_class(spark):
    """Ninety languages, each with letters of its own; one id with many rows brings one of them."""
    rows = [(i, chr(0x4E00 + i % 90) * 30, f"l{i % 90:02d}") for i in range(2700)]
    rows += [(3, f"{chr(0x4E03)} copy {n}", "l03") for n in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = language_id.learn(docs)
    assert network.languages == [f"l{n:02d}" for n in range(90)]
    again = language_id.learn(docs.repartition(7))
    assert all(np.array_equal(a, b) for a, b in (
        (network.out, again.out), (network.forward.read, again.forward.read)))


def plain_states(way, text):
    """States of one direction, byte by byte and unit by unit."""
    state, found = np.zeros(language_id.HIDDEN), []
    for byte in text:
        gate, carried = way.read[:, byte].astype(float), way.carry.astype(float) @ state
        h = language_id.HIDDEN
        update, reset = (1 / (1 + np.exp(-(gate[k * h:(k + 1) * h] + carried[k * h:(k + 1) * h]))) for k in (0, 1))
        candidate = np.tanh(gate[2 * h:] + reset * carried[2 * h:])
        state = state + update * (candidate - state)
        found.append(state)
    return found


def test_network_like_a_plain_loop():
    draw = np.random.default_rng(4)
    h = language_id.HIDDEN
    ways = [language_id.Direction(draw.normal(0, 0.5, (3 * h, 256)).astype(np.float32),
                                  draw.normal(0, 0.5, (3 * h, h)).astype(np.float32)) for _ in (0, 1)]
    network = language_id.Network(["a", "b", "c"], *ways, draw.normal(0, 0.5, (3, 2 * h + 1)).astype(np.float32))
    texts = [bytes(draw.integers(0, 256, n).astype(np.uint8)) for n in (0, 1, 5, 64, 65, 200)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    pooled, labelled = network.documents(data, np.r_[0, np.cumsum([len(t) for t in texts])])
    for text, own, share in zip(texts, pooled, labelled, strict=True):
        chances = []
        for begin in range(0, len(text), language_id.SPAN):
            part = text[begin:begin + language_id.SPAN]
            ahead, behind = plain_states(ways[0], part), plain_states(ways[1], part[::-1])[::-1]
            for a, b in zip(ahead, behind, strict=True):
                logits = network.out.astype(float) @ np.r_[a, b, 1.0]
                chances.append(np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum())
        expected = np.mean(chances, axis=0) if chances else np.zeros(3)
        assert np.allclose(own, expected, atol=1e-5)
        labels = np.bincount([c.argmax() for c in chances], minlength=3) / max(len(chances), 1)
        assert np.allclose(share, labels, atol=0.02)


def test_backpropagation_agrees_with_differences():
    draw = np.random.default_rng(0)
    spans = draw.integers(0, 256, (6, 3))
    mask = np.ones((6, 1, 3), np.float32)
    mask[4:, :, 1] = 0
    way = language_id.Direction(
        draw.normal(0, 0.5, (3 * language_id.HIDDEN, 256)).astype(np.float64),
        draw.normal(0, 0.5, (3 * language_id.HIDDEN, language_id.HIDDEN)).astype(np.float64))
    outer = draw.normal(0, 1, (6, language_id.HIDDEN, 3)).astype(np.float32) * mask
    kept = []
    way.run(spans, mask, kept)
    read, carry = way.gradients(spans, mask, kept, outer)
    for weights, gradient, at in ((way.carry, carry, (3, 2)), (way.carry, carry, (20, 5)),
                                  (way.read, read, (9, int(spans[2, 0])))):
        values = []
        for step in (1e-2, -1e-2):
            weights[at] += step
            values.append(float((way.run(spans, mask) * outer).sum(dtype=np.float64)))
            weights[at] -= step
        assert abs((values[0] - values[1]) / 2e-2 - gradient[at]) < 2e-2


def test_quality_of_held_out_documents(spark, documents):
    found = registry.queries()["op6_quality_classifier"](spark, FOLDER).collect()
    truth = {r["doc_id"]: r["quality"] for r in
             spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(found) == documents.count()
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in found)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in found)
    out = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in out]) > 0.95


def test_quality_of_odd_rows(odd, none, documents, spark, labels):
    found = quality.classify(odd, labels).collect()
    assert len(found) == odd.count()
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns
    assert kept.count() == sum(r["predicted"] for r in found)
    unknown = quality.classify(odd, labels.limit(0)).collect()
    assert {r["score"] for r in unknown} == {0.5}
    assert quality.classify(none, labels).collect() == []
    strange = spark.createDataFrame([(None, 1), (1, None), (4, 1), (4, 0), (99, 7)], "doc_id long, quality int")
    assert len(quality.classify(odd, strange).collect()) == odd.count()


def test_held_out_labels_are_never_learned(documents, spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality"))
        .otherwise(F.col("quality")))
    assert ordered(quality.classify(documents, flipped).collect()) == \
        ordered(quality.classify(documents, labels).collect())


def test_quality_scores_like_a_plain_loop(documents):
    """A batch's scores are, to the last digit, those of its texts alone: a sum over their features."""
    model = quality.fit([(np.arange(i % 7, 9000, 7), np.full(len(range(i % 7, 9000, 7)), 0.01), i % 2)
                         for i in range(60)])
    texts = [(r["text"] or "").encode() for r in documents.select("text").limit(200).collect()] + [b"", b"x"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])]
    for text, score in zip(texts, model.scores(data, offsets), strict=True):
        numbers, _ = quality.features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        total = sum(float(model.weights[n]) for n in numbers) * float(quality.SCALE) / max(len(numbers), 1)
        assert score == pytest.approx(1 / (1 + np.exp(-(total + model.bias))), abs=1e-12)
        assert score == model.scores(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]


def test_labels_with_clashing_columns_and_repeated_ids(spark, odd, labels):
    clash = labels.selectExpr("*", "'t' AS text", "1 AS label", "'k' AS key_text", "'x' AS row")
    assert ordered(quality.classify(odd, clash).collect()) == ordered(quality.classify(odd, labels).collect())
    twice = spark.createDataFrame([(i, f"good words {i} here", "en") for i in range(50)] * 2
                                  + [(i, f"bad 77 !! {i} %%", "en") for i in range(50)],
                                  "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    one, other = quality.learn(twice, marks), quality.learn(twice.repartition(5), marks)
    assert np.array_equal(one.weights, other.weights) and one.bias == other.bias


def test_ftrl_leaves_useless_weights_at_zero():
    rows = [(np.array([i % 2]), np.array([1.0]), i % 2) for i in range(200)]
    model = quality.fit(rows)
    assert model.weights[0] < 0 < model.weights[1] and not model.weights[2:].any()


def test_quality_driver_holds_no_python_number_for_a_feature(spark):
    words = np.random.default_rng(5).integers(0, 1 << 40, (24, 20_000))
    docs = spark.createDataFrame([(i, " ".join(np.base_repr(v, 36) for v in row)) for i, row in enumerate(words)],
                                 "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, quality int")
    tracemalloc.start()
    model = quality.learn(docs, marks)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert model.weights.any()
    assert peak < 48 << 20, peak
