"""Quality classifier: hashed word n-grams, logistic regression learned by FTRL-proximal updates.

Words are runs of letters, of digits or of other signs. A document's features are its word
n-grams and the n-grams of its words' shapes (letter case, digits, signs, repetition of one of the
two words before), hashed into a fixed number of weights; a feature's value is its share of all
features of the document. Learning takes a bounded sample of labelled rows, the same number of
each label at most; scoring is a sparse dot product per document, in the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.llm.flat import mix, row_ranges, text_buffers, words
from tradewake.llm.frames import bounded_batches, doc_texts, fingerprint, list_values, map_batches

DIMENSIONS = 1 << 18
# Share of a feature times this is its value; it sets the pace of learning, not its outcome.
SCALE = np.float32(32)
PER_LABEL = 1500
# Bytes of text whose features are held at once (about 60 times as many); no score depends on it.
BATCH_BYTES = 1 << 18

SIGNS = np.full(256, 3, np.uint8)
SIGNS[[0x20, *range(0x00, 0x20), 0x7F]] = 0
SIGNS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
SIGNS[[*range(0x30, 0x3A)]] = 2
CAPITAL = np.zeros(256, np.int64)
CAPITAL[65:91] = 1
SHAPE_GRAMS = (1, 2, 4)
WORD_GRAMS = (1, 2)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts laid end to end, and how many each text has."""
    hashes, starts, ends, counts = words(data, offsets, SIGNS)
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64), counts
    capitals = np.r_[0, np.cumsum(CAPITAL[data])]
    upper, size = capitals[ends] - capitals[starts], ends - starts
    shape = SIGNS[data[starts]].astype(np.uint64) * np.uint64(4)
    shape += np.where(upper == 0, 0, np.where(upper == size, 3, np.where(
        (upper == 1) & (CAPITAL[data[starts]] == 1), 1, 2))).astype(np.uint64)
    doc = np.repeat(np.arange(len(counts)), counts)
    for back in (1, 2):
        same = np.zeros(n, bool)
        same[back:] = (hashes[back:] == hashes[:-back]) & (doc[back:] == doc[:-back])
        shape += np.uint64(16 * back) * same
    found, owners = [], []
    for stream, (values, sizes) in enumerate(((hashes, WORD_GRAMS), (mix(shape), SHAPE_GRAMS))):
        for gram in sizes:
            full = n - gram + 1
            if full <= 0:
                continue
            total = np.full(full, np.uint64(1 + stream * 8 + gram), np.uint64)
            for j in range(gram):
                total *= np.uint64(0x9E3779B97F4A7C15)
                total += values[j:j + full]
            inside = doc[:full] == doc[gram - 1:]
            found.append((mix(total[inside]) & np.uint64(DIMENSIONS - 1)).astype(np.int32))
            owners.append(doc[:full][inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order], np.bincount(owner, minlength=len(counts))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        numbers, counts = features(data, offsets)
        # Every row is added up alone, so its score does not depend on its neighbours.
        total, own = np.zeros(len(counts)), counts > 0
        if own.any():
            total[own] = np.add.reduceat(self.weights[numbers].astype(np.float64),
                                         (np.cumsum(counts) - counts)[own])
        total *= float(SCALE) / np.maximum(counts, 1)
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 4, alpha: float = 0.2,
        beta: float = 1.0, l1: float = 0.02, l2: float = 0.05) -> Model:
    """Follow the regularised leader over rows of (feature numbers, values, label)."""
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    for _ in range(epochs):
        for numbers, values, label in rows:
            at, x = np.r_[numbers, DIMENSIONS], np.r_[np.asarray(values, np.float64), 1.0]
            w = weights(at)
            gradient = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
            step = (np.sqrt(n[at] + gradient ** 2) - np.sqrt(n[at])) / alpha
            z[at] += gradient - step * w
            n[at] += gradient ** 2
    learned = weights(np.arange(DIMENSIONS + 1))
    return Model(learned[:-1].astype(np.float32), float(learned[-1]))


def _sparse(batch: pa.RecordBatch):
    data, offsets = text_buffers(batch.column("text"))
    numbers, values = [], []
    for row in range(batch.num_rows):
        own, _ = features(data[offsets[row]:offsets[row + 1]], np.array([0, offsets[row + 1] - offsets[row]]))
        unique, times = np.unique(own, return_counts=True)
        numbers.append(unique)
        values.append((times * float(SCALE) / max(len(own), 1)).astype(np.float32))
    yield pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("label"), batch.column("key_text"),
         pa.array(numbers, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
        names=["doc_id", "label", "key_text", "numbers", "shares"])


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id never is."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality",
          per_label: int = PER_LABEL) -> Model:
    """Learn from labelled rows that are not held out.

    The sample is bounded: of each label the ``per_label`` ids that come first in hash order.
    The driver gets their features, at most ``2 * per_label`` sparse rows. Rows without id or
    label are no examples. Of several labels of an id the largest counts, of several texts the one
    with the smallest hash. Without examples all scores are 0.5.
    """
    bounded_batches(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")) \
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.filter(F.col("label") == value).orderBy(*order).limit(per_label) for value in (0, 1)]
    sample = picked[0].unionAll(picked[1])  # bounded by per_label, so its broadcast is too
    texts = doc_texts(docs).join(F.broadcast(sample), "doc_id") \
        .select("doc_id", "label", fingerprint(F.col("text")).alias("key_text"), "text")
    rows = map_batches(texts, _sparse, "doc_id long, label int, key_text binary, numbers array<int>, "
                                       "shares array<float>") \
        .groupBy("doc_id", "label").agg(F.min(F.struct("key_text", "numbers", "shares")).alias("one")) \
        .select("doc_id", "label", "one.numbers", "one.shares").toArrow() if sample.head(1) else None
    return fit(examples(rows) if rows is not None else [])


def examples(rows: pa.Table) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(feature numbers, values, label) in order of the ids' hashes: parts of the table's own buffers."""
    found = []
    for batch in rows.to_batches():
        own = [list_values(batch.column(name)) for name in ("numbers", "shares")]
        for row, (doc_id, label) in enumerate(zip(batch.column("doc_id").to_pylist(),
                                                  batch.column("label").to_pylist(), strict=True)):
            key = (mix(np.array([doc_id]).astype(np.uint64))[0], doc_id)
            found.append((key, *(values[at[row]:at[row + 1]] for at, values in own), label))
    return [row[1:] for row in sorted(found, key=lambda row: row[0])]


def score(model: Model) -> Column:
    """Scores of a text column, for use as ``score(model)(column)``."""
    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        data, offsets = text_buffers(texts)
        parts = [model.scores(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                 for i, j in row_ranges(offsets, BATCH_BYTES)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))
    return scores


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted: one row per row of ``docs``.

    Null and empty texts have no features and get the score of the bias alone. Repeated rows are
    scored alike, an empty table gives an empty result, other columns are not looked at.
    """
    model = learn(docs, labels)
    return doc_texts(docs).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        score(model)(F.col("text")).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the classifier accepts, all columns kept."""
    good = score(learn(docs, labels))(F.coalesce(docs["text"], F.lit(""))) >= 0.5
    return docs.filter(good)
