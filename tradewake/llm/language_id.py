"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads the bytes of a text, forwards and backwards, and gives every position a
probability for each language; a document's probabilities are the means over its positions. States
begin anew every ``SPAN`` bytes, so all spans of many texts run side by side as the columns of
matrices, and a long text costs no more per byte than a short one. Learning is backpropagation
through time, written in numpy, over a bounded sample of labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewake.llm.flat import row_ranges, text_buffers
from tradewake.llm.frames import fingerprint, map_batches
from tradewake.llm.quality import held_out
from tradewake.session import stored

HIDDEN = 8
SPAN = 64
BATCH_BYTES = 1 << 18
# The sample: so many rows of a language, fewer if there are very many languages; spans of each row.
ROWS_PER_LANGUAGE, SAMPLE_ROWS, SPANS_PER_ROW = 500, 32_000, 6
UNKNOWN = "und"


@dataclass
class Direction:
    """Weights of one reading direction; gates in the order update, reset, candidate."""

    read: np.ndarray  # (3 * HIDDEN, 256): what a byte adds to the gates
    carry: np.ndarray  # (3 * HIDDEN, HIDDEN): what the state adds

    def run(self, spans: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each byte; ``spans`` and ``mask`` are (SPAN, columns)."""
        steps, width = spans.shape
        states = np.empty((steps, HIDDEN, width), np.float32)
        state = np.zeros((HIDDEN, width), np.float32)
        gates = np.empty((3 * HIDDEN, width), np.float32)
        carried = np.empty_like(gates)
        for step in range(steps):
            np.take(self.read, spans[step], axis=1, out=gates, mode="clip")
            np.matmul(self.carry, state, out=carried)
            both = gates[:2 * HIDDEN]
            both += carried[:2 * HIDDEN]
            np.negative(both, out=both)
            np.exp(both, out=both)
            both += 1
            np.reciprocal(both, out=both)
            update, reset = both[:HIDDEN], both[HIDDEN:]
            candidate = gates[2 * HIDDEN:]
            candidate += reset * carried[2 * HIDDEN:]
            np.tanh(candidate, out=candidate)
            after = states[step]
            np.subtract(candidate, state, out=after)
            after *= update
            after += state
            after *= mask[step]
            if keep is not None:
                keep.append((state.copy(), update.copy(), reset.copy(), candidate.copy(),
                             carried[2 * HIDDEN:].copy()))
            state = after
        return states

    def gradients(self, spans: np.ndarray, mask: np.ndarray, kept: list,
                  outer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of read and carry, given those of the states; backwards through time."""
        steps, width = spans.shape
        flow = np.zeros((HIDDEN, width), np.float32)
        carry = np.zeros_like(self.carry)
        to_gates = np.empty((3 * HIDDEN, steps, width), np.float32)
        for step in range(steps - 1, -1, -1):
            before, update, reset, candidate, carried = kept[step]
            flow = (flow + outer[step]) * mask[step]
            d_update = flow * (candidate - before) * update * (1 - update)
            d_candidate = flow * update * (1 - candidate * candidate)
            d_reset = d_candidate * carried * reset * (1 - reset)
            to_gates[:, step] = np.concatenate([d_update, d_reset, d_candidate])
            to_state = np.concatenate([d_update, d_reset, d_candidate * reset])
            carry += to_state @ before.T
            flow = flow * (1 - update) + self.carry.T @ to_state
        flat = spans.reshape(-1)
        read = np.stack([np.bincount(flat, g.reshape(-1), 256) for g in to_gates])
        return read.astype(np.float32), carry


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # (languages, 2 * HIDDEN + 1); the last column is the bias

    def positions(self, spans: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Probabilities of all languages at all positions: (SPAN, languages, columns)."""
        ahead = self.forward.run(spans, mask)
        behind = self.backward.run(spans[::-1], mask[::-1])[::-1]
        return self._softmax(ahead, behind)

    def _softmax(self, ahead: np.ndarray, behind: np.ndarray) -> np.ndarray:
        logits = np.matmul(self.out[:, :HIDDEN], ahead)
        logits += np.matmul(self.out[:, HIDDEN:2 * HIDDEN], behind)
        logits += self.out[:, -1:]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per document the mean probabilities, and the share of positions of each language."""
        rows, kinds = len(offsets) - 1, len(self.languages)
        pooled, labelled = np.zeros((rows, kinds)), np.zeros((rows, kinds))
        sizes = np.diff(offsets)
        spans_of = -(-sizes // SPAN)
        owner = np.repeat(np.arange(rows), spans_of)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(spans_of) - spans_of, spans_of)
        begins = offsets[owner] + nth * SPAN
        ends = offsets[owner + 1]
        wide = BATCH_BYTES // SPAN
        for first in range(0, len(owner), wide):
            own = owner[first:first + wide]
            at = begins[first:first + wide] + np.arange(SPAN)[:, None]
            inside = at < ends[first:first + wide]
            spans = data[np.minimum(at, len(data) - 1)]
            mask = inside.astype(np.float32)
            chance = self.positions(spans, mask[:, None])
            best = chance.argmax(axis=1)
            sums = np.einsum("tlb,tb->lb", chance, mask)
            for kind in range(kinds):
                pooled[:, kind] += np.bincount(own, sums[kind], rows)
                labelled[:, kind] += np.bincount(own, ((best == kind) & inside).sum(axis=0), rows)
        size = np.maximum(sizes, 1)[:, None]
        return pooled / size, labelled / size


def fit(spans: np.ndarray, mask: np.ndarray, labels: np.ndarray, languages: list[str],
        epochs: int = 3, batch: int = 128, pace: float = 0.02, seed: int = 7) -> Network:
    """Learn from spans (SPAN, n) of known language by Adam on the mean loss over positions."""
    draw = np.random.default_rng(seed)
    sizes = [(3 * HIDDEN, 256), (3 * HIDDEN, HIDDEN), (3 * HIDDEN, 256), (3 * HIDDEN, HIDDEN),
             (len(languages), 2 * HIDDEN + 1)]
    weights = [draw.normal(0, 0.3, s).astype(np.float32) for s in sizes]
    network = Network(languages, Direction(*weights[:2]), Direction(*weights[2:4]), weights[4])
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step, total = 0, epochs * -(-spans.shape[1] // batch)
    for _ in range(epochs):
        order = draw.permutation(spans.shape[1])
        for begin in range(0, len(order), batch):
            pick = order[begin:begin + batch]
            x, m, y = spans[:, pick], mask[:, None, pick], labels[pick]
            kept_a, kept_b = [], []
            ahead = network.forward.run(x, m, kept_a)
            behind = network.backward.run(x[::-1], m[::-1], kept_b)[::-1]
            error = network._softmax(ahead, behind)
            error[:, y, np.arange(len(y))] -= 1
            error *= m / max(float(m.sum()), 1.0)
            states = np.concatenate([ahead, behind, np.ones_like(ahead[:, :1])], axis=1)
            g_out = np.einsum("tlb,thb->lh", error, states)
            g_ahead = np.matmul(network.out[:, :HIDDEN].T, error)
            g_behind = np.matmul(network.out[:, HIDDEN:2 * HIDDEN].T, error)
            gradients = [*network.forward.gradients(x, m, kept_a, g_ahead),
                         *network.backward.gradients(x[::-1], m[::-1], kept_b, g_behind[::-1]),
                         g_out]
            step += 1
            rate = pace * (1 - step / (total + 1))
            for w, g, a, b in zip(weights, gradients, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                w -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return network


def learn(docs: DataFrame) -> Network | None:
    """Learn from text and lang of rows that are not held out; None without any such row.

    Every language is a class. The sample is bounded: of each the ``ROWS_PER_LANGUAGE`` ids that come
    first in hash order, at most ``SAMPLE_ROWS`` together (but one of each), and ``SPANS_PER_ROW``
    pieces of each. Of several texts of an id in a language the one with the smallest hash counts.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
        & F.col("text").isNotNull())
    counts = stored(known.groupBy(F.col("lang").alias("class")).agg(F.count("*").alias("n")), "languages")
    languages = sorted(row["class"] for row in counts.select("class").collect())
    if not languages:
        return None
    each = max(1, min(ROWS_PER_LANGUAGE, SAMPLE_ROWS // len(languages)))
    # Twice the rows wanted, and some, have a hash below this share of all; of those the first count.
    order = F.xxhash64("doc_id")
    share = F.least(F.lit(1.0), (2 * each + 50) / F.col("n"))
    early = order.cast("double") <= share * 2.0 ** 64 - 2.0 ** 63
    texts = known.join(F.broadcast(counts), F.col("lang") == F.col("class")).filter(early) \
        .groupBy("lang", "doc_id").agg(F.min(F.struct(fingerprint(F.col("text")).alias("key"), "text")).alias("one"))
    first = Window.partitionBy("lang").orderBy(order, "doc_id")
    place = F.pmod(F.xxhash64("doc_id", "nth"), F.greatest(F.char_length("text") - SPAN, F.lit(0)) + 1)
    rows = texts.select("doc_id", "lang", F.col("one.text").alias("text")) \
        .withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= each) \
        .withColumn("nth", F.explode(F.sequence(F.lit(1), F.lit(SPANS_PER_ROW)))) \
        .select("doc_id", "nth", "lang", F.substring("text", (place + 1).cast("int"), F.lit(SPAN)).alias("piece")) \
        .filter("piece <> ''").orderBy("doc_id", "nth", "piece", "lang").collect()
    if not rows:
        return None
    spans = np.zeros((SPAN, len(rows)), np.uint8)
    mask = np.zeros((SPAN, len(rows)), np.float32)
    for column, row in enumerate(rows):
        own = np.frombuffer(row["piece"].encode()[:SPAN], np.uint8)
        spans[:len(own), column], mask[:len(own), column] = own, 1
    labels = np.array([languages.index(row["lang"]) for row in rows])
    return fit(spans, mask, labels, languages)


RESULT = ("doc_id long, held_out boolean, lang_pred string, score double, "
          "shares array<struct<lang: string, probability: double, positions: double>>")


def _identify(batch: pa.RecordBatch, network: Network | None):
    texts = batch.column(2)
    letters = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
    data, offsets = text_buffers(texts)
    if network is None or not len(data):
        pooled = labelled = np.zeros((batch.num_rows, len(network.languages) if network else 0))
    else:
        parts = [network.documents(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                 for i, j in row_ranges(offsets, 8 * BATCH_BYTES)]
        pooled, labelled = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    names = network.languages if network else []
    lang, score, shares = [], [], []
    for has_letter, own, share in zip(letters, pooled, labelled, strict=True):
        known = has_letter and len(names) > 0
        best = int(own.argmax()) if known else -1
        lang.append(names[best] if known else UNKNOWN)
        score.append(min(1.0, float(own[best])) if known else 0.0)
        shares.append([{"lang": n, "probability": float(p), "positions": float(s)}
                       for n, p, s in zip(names, own, share, strict=True)])
    share_type = pa.list_(pa.struct([("lang", pa.string()), ("probability", pa.float64()),
                                     ("positions", pa.float64())]))
    yield pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(lang, pa.string()),
         pa.array(score, pa.float64()), pa.array(shares, share_type)],
        names=["doc_id", "held_out", "lang_pred", "score", "shares"])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, shares: one row per row of ``docs``.

    ``shares`` has for every language the mean probability and the share of positions labelled
    with it. Texts that are null or have no letter are ``und`` with score 0, as are all texts if
    no row can be learned from. Of equal probabilities the language first in order wins. Repeated
    rows get the same result, an empty table an empty one; only doc_id, text and lang are looked
    at, and the last only to learn.
    """
    network = learn(docs)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id").cast("long")).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"), has_letter(F.col("text")).alias("letters"))
    return map_batches(texts, lambda batch: _identify(batch, network), RESULT)
