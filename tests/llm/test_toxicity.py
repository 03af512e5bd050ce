from __future__ import annotations

import zlib

import numpy as np
import pytest
from conftest import ordered
from pyspark.sql import functions as F

from tradewake.llm import registry, toxicity

FOLDER = "/root/testdata/sf0.01"


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_query_scores_every_document(spark, documents):
    found = registry.queries()["op12_toxicity"](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(r["doc_id"] for r in documents.collect())
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in found)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in found)
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    out = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in out]) > 0.9


def made_up(spark, n=1500):
    """Documents of common words, a fifth of them with words that only toxic documents have."""
    draw = np.random.default_rng(5)
    common = ["".join(draw.choice(list("aeiorstln"), draw.integers(2, 6))) for _ in range(300)]
    bad = ["gruffelig", "zwackser", "knuddrig", "quarkhaft"]
    rows = []
    for doc_id in range(n):
        words = list(draw.choice(common, draw.integers(20, 200)))
        toxic = int(doc_id % 5 == 0)
        for _ in range(3 * toxic):
            words.insert(int(draw.integers(len(words))), str(draw.choice(bad)))
        rows.append((doc_id, " ".join(words), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), dict((r[0], r[2]) for r in rows)


def test_planted_words_are_learned(spark):
    docs, labels, truth = made_up(spark)
    out = [r for r in toxicity.classify(docs, labels).collect() if r["held_out"]]
    assert len(out) > 200
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in out]) > 0.97
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    left = {r["doc_id"] for r in kept.collect()}
    assert sum(truth[i] for i in left) < 0.05 * sum(truth.values())
    assert len(left) > 0.97 * sum(1 - t for t in truth.values())


def test_held_out_labels_and_other_columns_are_never_used(spark, documents):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic"))
        .otherwise(F.col("toxic"))).withColumn("text", F.lit("clash"))
    changed = documents.withColumn("lang", F.lit("x")).withColumn("label", F.lit(7))
    assert ordered(toxicity.classify(changed, flipped).collect()) == \
        ordered(toxicity.classify(documents, labels).collect())


def test_odd_rows(spark, odd, none, labels):
    found = toxicity.classify(odd, labels).collect()
    assert len(found) == odd.count()
    same = [r["score"] for r in found if r["doc_id"] == 10]
    assert len(same) == 2 and len(set(same)) == 1
    kept = toxicity.drop_toxic(odd, labels)
    assert kept.columns == odd.columns
    assert kept.count() == sum(1 - r["predicted"] for r in found)
    assert {r["score"] for r in toxicity.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert toxicity.classify(none, labels).collect() == []
    strange = spark.createDataFrame([(None, 1), (1, None), (4, 1), (4, 0), (99, 7)],
                                    "doc_id long, toxic int")
    assert len(toxicity.classify(odd, strange).collect()) == odd.count()


def plain_windows(text: bytes):
    """Cuts of one text, found byte by byte."""
    cuts = []
    for at in range(0, len(text), toxicity.WINDOW):  # none for an empty text
        inside = range(at, min(at + toxicity.WINDOW, len(text)))
        begins = [i for i in inside if text[i] != 32 and i > 0 and text[i - 1] == 32]
        cuts.append(0 if at == 0 else begins[0] if begins else at)
    return [text[a:b] for a, b in zip(cuts, cuts[1:] + [len(text)] * bool(text), strict=True)]


def test_windows_and_scores_like_a_plain_loop():
    """A batch of texts is cut and scored as every text alone is, window by window."""
    draw = np.random.default_rng(1)
    texts = [b"", b" ", b"word", b"x" * 500, b"  two  words ", b"a b c " * 40]
    texts += [bytes(draw.choice(list(b"abcdefg   "), draw.integers(1, 300))) for _ in range(60)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    begins, ends, counts = toxicity.windows(data, offsets)
    found = [data[a:b].tobytes() for a, b in zip(begins, ends, strict=True)]
    expected = [plain_windows(t) for t in texts]
    assert found == [w for own in expected for w in own]
    assert counts.tolist() == [len(own) for own in expected]
    model = toxicity.Model(b"gab cab abc fed ", b" deaf ", tuple(np.arange(13.0)), (0.7, 0.2, -0.3), -0.5)
    for text, score in zip(texts, model.scores(data, offsets), strict=True):
        own = plain_windows(text)
        gains = [sum(s * len(toxicity.compressor(book).compress(toxicity.CARRIER + w))
                     for s, book in ((1, model.ordinary), (-1, model.ordinary + model.toxic))) for w in own]
        evidence = sum(min(max(gain, 0), 12) for gain in gains)
        x = 0.7 * np.log1p(evidence) + 0.2 * evidence / max(len(own), 1) - 0.3 * np.log1p(len(own)) - 0.5
        assert score == pytest.approx(1 / (1 + np.exp(-x)))
