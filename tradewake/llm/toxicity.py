"""Toxicity: compression distance to two zstandard dictionaries, window by window.

A text is lower-cased and cut at word starts into windows of about ``WINDOW`` bytes. Every window is
compressed twice: with a dictionary trained on ordinary text, and with the same dictionary plus a
part trained on toxic text. The bytes saved by that part are the window's gain. Dictionaries are raw
content, so unmatched letters cost a byte each, and every window begins with a fixed run of bytes
that both dictionaries hold: the block is then always worth compressing, and small gains show.

Most words of a toxic document are ordinary, so the toxic part is learned in rounds. The sample has
three folds. Two train a dictionary each; windows of one fold that the other fold's dictionary
shortens clearly more than ordinary windows are what the next round trains on. What the two last
dictionaries agree on is cut into words, and a word stays only if it alone shortens toxic windows
more often than ordinary ones. The third fold, which no dictionary has seen, calibrates: how much
evidence a gain is, and the threshold that a document's evidence must pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.llm.flat import mix, row_ranges, text_buffers
from tradewake.llm.frames import doc_texts, fingerprint, map_batches

WINDOW = 24
# Learning takes at most so many documents of each label, and so many windows of each of them.
PER_LABEL = 2400
PER_DOCUMENT = 160
ORDINARY_BYTES = 8192
# Sizes of the toxic dictionary, round by round: first wide, then what proved useful.
ROUNDS = (16384, 8192, 4096, 2048, 2048, 2048)
# A window is taken into the next round if its gain is above this quantile of ordinary windows.
CLEAR = 0.97
AGREED = 5
VETTED = 8000
# A word stays that shortens windows of so many times as many toxic as ordinary documents.
SHORTENED = 2
TIMES = 3
DOUBT = 2
AGREEING = 4096
MOST_GAIN = 12
BATCH_BYTES = 1 << 20

# Fixed bytes that hardly occur in texts.
CARRIER = bytes([*range(1, 9), *range(14, 32), 0x7F, 0x00]) + b" "

PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[65:91] += 32
PLAIN[9:14] = 32


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every window of plain bytes, and the number of windows of every row.

    A row's bytes are divided into bins of ``WINDOW``. A window begins with the first word that
    begins in a bin; a bin inside a longer word begins one itself. So every byte is in exactly one
    window, and none is longer than two bins.
    """
    bins = -(-np.diff(offsets) // WINDOW)
    first = np.cumsum(bins) - bins
    row = np.repeat(np.arange(len(bins)), bins)
    cuts = offsets[row] + (np.arange(len(row)) - first[row]) * WINDOW
    if not len(cuts):
        return cuts, cuts, bins
    space = data == 32
    begins = np.flatnonzero(~space[1:] & space[:-1]) + 1
    owner = np.searchsorted(offsets, begins, "right") - 1
    place = first[owner] + (begins - offsets[owner]) // WINDOW
    earliest = np.r_[True, place[1:] != place[:-1]] if len(place) else np.zeros(0, bool)
    cuts[place[earliest]] = begins[earliest]
    cuts[first[bins > 0]] = offsets[:-1][bins > 0]
    ends = np.r_[cuts[1:], offsets[-1]]
    return cuts, ends, bins


def framed(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows behind one another, each after the carrier, and their offsets."""
    sizes = ends - begins
    offsets = np.r_[0, np.cumsum(sizes + len(CARRIER))]
    out = np.empty(offsets[-1], np.uint8)
    out[(offsets[:-1, None] + np.arange(len(CARRIER))).ravel()] = np.tile(
        np.frombuffer(CARRIER, np.uint8), len(sizes))
    step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(offsets[:-1] + len(CARRIER), sizes) + step] = data[np.repeat(begins, sizes) + step]
    return out, offsets


@lru_cache(maxsize=256)
def compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=13, chain_log=13, search_log=5, min_match=4, target_length=32,
        strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_checksum=0,
        write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    book = zstandard.ZstdCompressionDict(content + CARRIER,
                                         dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    book.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=book, compression_params=settings)


def lengths(content: bytes, out: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Compressed length of every framed window, each on its own."""
    if len(offsets) < 2:
        return np.zeros(0, np.int64)
    parts = np.stack([offsets[:-1], np.diff(offsets)], axis=1).astype(np.uint64)
    pieces = compressor(content).multi_compress_to_buffer(
        zstandard.BufferWithSegments(out.tobytes(), parts.tobytes()))
    return np.fromiter(map(len, pieces), np.int64, len(parts))


def train(size: int, samples: list[bytes]) -> bytes:
    """Content of a trained dictionary; of too few samples, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=16, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def agreed(one: bytes, other: bytes) -> list[bytes]:
    """Words of the parts of ``one`` whose every run of ``AGREED`` bytes is in ``other``, in order."""
    runs = {other[i:i + AGREED] for i in range(len(other) - AGREED + 1)}
    shared = bytearray(len(one))
    for i in range(len(one) - AGREED + 1):
        if one[i:i + AGREED] in runs:
            shared[i:i + AGREED] = b"\1" * AGREED
    spelled = bytes(c if s else 32 for c, s in zip(one, shared, strict=True))
    return sorted({word for word in spelled.split() if 4 <= len(word) <= WINDOW})


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    evidence: tuple[float, ...]  # of gains 0, 1, ... MOST_GAIN
    weights: tuple[float, ...]   # of the features below
    bias: float

    def gains(self, out: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not self.toxic:
            return np.zeros(len(offsets) - 1, np.int64)
        return lengths(self.ordinary, out, offsets) - lengths(self.ordinary + self.toxic, out, offsets)

    def features(self, gains: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Of every document: its evidence, the same per window, and the number of windows."""
        found = np.array(self.evidence)[np.clip(gains, 0, MOST_GAIN)]
        sums = np.zeros(len(counts))
        own = counts > 0
        if own.any():
            sums[own] = np.add.reduceat(found, (np.cumsum(counts) - counts)[own])
        return np.stack([np.log1p(sums), sums / np.maximum(counts, 1), np.log1p(counts)], axis=1)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        plain = PLAIN[data]
        begins, ends, counts = windows(plain, offsets)
        features = self.features(self.gains(*framed(plain, begins, ends)), counts)
        return probability((features * np.array(self.weights)).sum(axis=1) + self.bias)


def probability(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _framed_list(samples: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(samples), np.uint8)
    ends = np.cumsum([len(s) for s in samples], dtype=np.int64) if samples else np.zeros(0, np.int64)
    return framed(data, np.r_[0, ends[:-1]].astype(np.int64)[:len(ends)], ends)


def _flat(documents: list[list[bytes]]) -> list[bytes]:
    return [window for document in documents for window in document]


def _candidates(base: bytes, samples: list[list[list[bytes]]]) -> set[bytes]:
    """Words that two dictionaries agree on, trained in rounds on either fold of the toxic windows.

    ``samples`` has the windows of toxic and of ordinary documents, two folds each.
    """
    texts = [[_framed_list(fold) for fold in folds] for folds in samples]
    before = [[lengths(base, *text) for text in folds] for folds in texts]
    chosen, words = samples[0], set()
    for size in ROUNDS:
        books = [train(size, fold) for fold in chosen]
        if size <= AGREEING:
            words.update(agreed(*books))
        following = []
        for fold in (0, 1):
            gains = [before[label][fold] - lengths(base + books[1 - fold], *texts[label][fold])
                     for label in (0, 1)]
            least = max(1, int(np.quantile(gains[1], CLEAR)) + 1) if len(gains[1]) else 1
            following.append([w for w, gain in zip(samples[0][fold], gains[0], strict=True)
                              if gain >= least])
        if not all(following):
            break
        chosen = following
    return words


def _toxic_words(ordinary: bytes, folds: list[list[list[list[bytes]]]]) -> bytes:
    """The toxic part of the dictionary, learned from two folds of documents of either label."""
    samples = [[_flat(fold) for fold in own] for own in folds]
    words = sorted(_candidates(ordinary, samples))
    # A word can only shorten windows that all words together shorten: these judge it.
    together = ordinary + b" " + b" ".join(words) + b" "
    every = [own[0] + own[1] for own in samples]
    useful = []
    for own in every:
        text = _framed_list(own)
        useful.append(lengths(ordinary, *text) - lengths(together, *text) >= SHORTENED)
    step = -(-max(map(np.count_nonzero, useful)) // VETTED) or 1
    judges = []
    for label in (0, 1):
        owner = np.repeat(np.arange(sum(map(len, folds[label]))),
                          [len(document) for fold in folds[label] for document in fold])
        at = np.flatnonzero(useful[label])[::step]
        text = _framed_list([every[label][i] for i in at])
        judges.append((text, lengths(ordinary, *text), owner[at]))
    documents = [sum(map(len, own)) for own in folds]
    kept = []
    for word in words:
        piece = b" " + word + b" "
        shorter = [len(np.unique(owner[base - lengths(ordinary + piece, *text) >= SHORTENED]))
                   for text, base, owner in judges]
        if shorter[0] * documents[1] >= TIMES * (shorter[1] + DOUBT) * documents[0]:
            kept.append((shorter[0], piece))
    return b"".join(piece for _, piece in sorted(kept))  # what helps most stands last: near is cheap


def _once(folds: list[list[list[bytes]]]) -> list[list[list[bytes]]]:
    """Both folds with every window only where it occurs first: copies prove nothing."""
    seen: set[bytes] = set()
    return [[[w for w in own if not (w in seen or seen.add(w))] for own in fold] for fold in folds]


def _regression(x: np.ndarray, y: np.ndarray, share: float) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, its bias moved to where ``share`` of all are toxic."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    ridge = np.diag([1.0] * x.shape[1] + [1e-6])
    for _ in range(25):
        p = probability(z @ w)
        w -= np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge,
                             z.T @ (p - y) + ridge @ w)
    weights = w[:-1] / spread
    drawn = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    shift = np.log(share / (1 - share)) - np.log(drawn / (1 - drawn))
    return weights, float(w[-1] - (weights * mean).sum() + shift)


def fit(rows: list[tuple[int, list[bytes]]], share: float) -> Model:
    """A model from (label, windows) of documents; ``share`` of all labelled documents are toxic.

    The order of rows decides their folds. Without examples of both labels nothing can be told
    apart: every score is then ``share``.
    """
    folds = {label: [[own for at, own in enumerate(w for is_label, w in rows if is_label == label)
                      if at % 3 == fold] for fold in range(3)] for label in (0, 1)}
    share = min(max(share, 1e-6), 1 - 1e-6)
    if not all(folds[label][fold] for label in (0, 1) for fold in range(3)):
        return Model(b"", b"", (0.0,) * (MOST_GAIN + 1), (0.0,) * 3, float(np.log(share / (1 - share))))
    learned = [_once(folds[label][:2]) for label in (0, 1)]
    ordinary = train(ORDINARY_BYTES, _flat(learned[0][0]) + _flat(learned[0][1]))
    toxic = _toxic_words(ordinary, learned[::-1])
    bare = Model(ordinary, toxic, (0.0,) * (MOST_GAIN + 1), (0.0,) * 3, 0.0)
    last = [folds[label][2] for label in (0, 1)]
    gains = [bare.gains(*_framed_list(_flat(documents))) for documents in last]
    seen = [np.bincount(np.clip(g, 0, MOST_GAIN), minlength=MOST_GAIN + 1) + 0.5 for g in gains]
    evidence = np.maximum.accumulate(np.log(seen[1] / seen[1].sum()) - np.log(seen[0] / seen[0].sum()))
    evidence = np.maximum(evidence, 0)
    evidence[0] = 0
    measured = Model(ordinary, toxic, tuple(evidence), (0.0,) * 3, 0.0)
    x = np.concatenate([measured.features(g, np.array([len(d) for d in documents]))
                        for g, documents in zip(gains, last, strict=True)])
    y = np.repeat([0.0, 1.0], [len(documents) for documents in last])
    weights, bias = _regression(x, y, share)
    return Model(ordinary, toxic, tuple(evidence), tuple(weights), bias)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is a multiple of 5; a null id never is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample_windows(batch: pa.RecordBatch):
    """Windows of every document, of long ones ``PER_DOCUMENT`` spread evenly over all the text."""
    data, offsets = text_buffers(batch.column("text"))
    found = []
    for row in range(batch.num_rows):
        own = PLAIN[data[offsets[row]:offsets[row + 1]]]
        begins, ends, _ = windows(own, np.array([0, len(own)]))
        picked = np.unique(np.linspace(0, len(begins) - 1, min(len(begins), PER_DOCUMENT)).astype(int)) \
            if len(begins) else []
        found.append([own[begins[i]:ends[i]].tobytes() for i in picked])
    yield pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("label"), batch.column("key_text"),
         pa.array(found, pa.list_(pa.binary()))], names=["doc_id", "label", "key_text", "windows"])


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic",
          per_label: int = PER_LABEL) -> Model:
    """Learn from labelled rows that are not held out.

    The sample is bounded: of each label the ``per_label`` ids that come first in hash order, at
    most ``PER_DOCUMENT`` windows of each. Rows without id or label are no examples; of several
    labels of an id the largest counts, of several texts the one with the smallest hash.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col(label).cast("int").alias("label")) \
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = dict(known.groupBy("label").count().toArrow().to_pandas().itertuples(index=False))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.filter(F.col("label") == value).orderBy(*order).limit(per_label)
              for value in (0, 1)]
    sample = picked[0].unionAll(picked[1])  # bounded by per_label, so its broadcast is too
    texts = doc_texts(docs).join(F.broadcast(sample), "doc_id") \
        .select("doc_id", "label", fingerprint(F.col("text")).alias("key_text"), "text")
    rows = map_batches(texts, _sample_windows,
                       "doc_id long, label int, key_text binary, windows array<binary>") \
        .groupBy("doc_id", "label").agg(F.min(F.struct("key_text", "windows")).alias("first")) \
        .select("doc_id", "label", "first.windows").toArrow().to_pylist() if counts else []
    rows.sort(key=lambda r: (int(mix(np.array([r["doc_id"]]).astype(np.uint64))[0]), r["doc_id"]))
    total = sum(counts.values())
    return fit([(r["label"], r["windows"]) for r in rows],
               counts.get(1, 0) / total if total else 0.5)


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

    The score is the probability that a text is toxic, from the text alone. Null and empty texts
    have no windows and get the score of no evidence. Repeated rows are scored alike, an
    empty table gives an empty result, and other columns are not looked at.
    """
    model = learn(docs, labels)
    return doc_texts(docs).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        score(model)(F.col("text")).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are not predicted to be toxic, all columns kept."""
    return docs.filter(score(learn(docs, labels))(F.coalesce(docs["text"], F.lit(""))) < 0.5)
