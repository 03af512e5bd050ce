"""Benchmark decontamination as a prefix-filtered set join.

A window is ten consecutive words of an item, or a shorter item as a whole. Its tokens are its
word shingles, ordered by how often they occur in the documents. A document that contains the
window contains all its tokens, so the prefix that is necessary for a join is one token: the rarest.
A task passes on the places of a document whose shingle may be such a prefix token, by a bitmap of
fixed size; they are joined with the windows on the token, position and length bounds drop windows
that would begin before or end after the document, and the words around the place are compared with
the words of the window. Occurrence counts cover all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.llm.flat import ALPHANUMERIC, LOWER, mix, row_ranges, shingles, text_buffers, words
from tradewake.llm.frames import (bitmap, bounded_batches, doc_texts, fingerprint, map_batches, may_be,
                                   rows_of)
from tradewake.session import stored

WINDOW = 10
TOKEN_WORDS = 3
BATCH_BYTES = 1 << 19
# Bits of the bitmaps that tasks look tokens up in: 2 MiB, whatever the size of the benchmark.
BITS = 1 << 24


def _tokens(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of ``size`` words as signed 64-bit numbers, and their positions."""
    values, positions, _ = shingles(hashes, counts, size, whole=False)
    return mix(values + np.uint64(size)).view(np.int64), positions


def _lower_words(text: bytes, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    return [text[a:b].decode("utf-8", "replace") for a, b in zip(starts, ends, strict=True)]


def _windows(batch: pa.RecordBatch, window: int):
    data, offsets = text_buffers(batch.column(1))
    hashes, starts, ends, counts = words(data, offsets, ALPHANUMERIC)
    spelled = _lower_words(LOWER[data].tobytes(), starts, ends)
    ids = batch.column(0).to_pylist()
    begins = np.cumsum(counts) - counts
    out = {"item_id": [], "words": [], "tokens": []}
    for row, (begin, n) in enumerate(zip(begins, counts, strict=True)):
        size = min(int(n), window)
        if not size:
            continue
        token_size = min(size, TOKEN_WORDS)
        tokens, _ = _tokens(hashes[begin:begin + n], np.array([n]), token_size)
        for at in range(int(n) - size + 1):
            out["item_id"].append(ids[row])
            out["words"].append(spelled[begin + at:begin + at + size])
            out["tokens"].append(tokens[at:at + size - token_size + 1])
    yield pa.RecordBatch.from_arrays(
        [pa.array(out["item_id"], pa.string()), pa.array(out["words"], pa.list_(pa.string())),
         pa.array(out["tokens"], pa.list_(pa.int64()))], names=list(out))


def _bitmaps(tokens: DataFrame) -> dict[int, np.ndarray]:
    """A bitmap of the tokens of each size that occurs; there are TOKEN_WORDS sizes."""
    sizes = [row[0] for row in tokens.select("token_size").distinct().collect()]
    return {size: bitmap(tokens.filter(F.col("token_size") == size).select("token"), BITS)
            for size in sizes}


def _count(batch: pa.RecordBatch, maps):
    data, offsets = text_buffers(batch.column(0))
    for first, last in row_ranges(offsets, BATCH_BYTES):
        hashes, _, _, counts = words(data[offsets[first]:offsets[last]],
                                     offsets[first:last + 1] - offsets[first], ALPHANUMERIC)
        for size, bitmap in maps.value.items():
            tokens, _ = _tokens(hashes, counts, size)
            found, times = np.unique(tokens[may_be(bitmap, tokens)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times)],
                                             names=["token", "times"])


PROBE = ("row long, doc_id long, key_text binary, n_words long, token long, at long, "
         "first long, around array<string>")


def _probe(batch: pa.RecordBatch, maps, window: int):
    data, offsets = text_buffers(batch.column(3))
    for first, last in row_ranges(offsets, BATCH_BYTES):
        part = data[offsets[first]:offsets[last]]
        hashes, starts, ends, counts = words(part, offsets[first:last + 1] - offsets[first],
                                             ALPHANUMERIC)
        lower = LOWER[part].tobytes()
        finish = np.cumsum(counts)
        begin = finish - counts
        owner = [np.arange(len(counts))]
        token, at, low, around = [None] * len(counts), [None] * len(counts), \
            [None] * len(counts), [None] * len(counts)
        for size, bitmap in maps.value.items():
            tokens, positions = _tokens(hashes, counts, size)
            hit = may_be(bitmap, tokens)
            tokens, positions = tokens[hit], positions[hit]
            doc = np.searchsorted(finish, positions, "right")
            left = np.maximum(positions - window + 1, begin[doc])
            right = np.minimum(positions + size + window - 1, finish[doc])
            owner.append(doc)
            token += tokens.tolist()
            at += (positions - begin[doc]).tolist()
            low += (left - begin[doc]).tolist()
            around += [_lower_words(lower, starts[a:b], ends[a:b])
                       for a, b in zip(left, right, strict=True)]
        owner = np.concatenate(owner)
        rows = pa.array(owner + first)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).take(rows) for c in range(3)] +
            [pa.array(counts[owner], pa.int64()), pa.array(token, pa.int64()),
             pa.array(at, pa.int64()), pa.array(low, pa.int64()),
             pa.array(around, pa.list_(pa.string()))],
            names=[c.split()[0] for c in PROBE.split(", ")])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans.

    One row per row of ``docs``. ``items`` are the ids, as strings in order, of the items with a
    window in the document; ``spans`` the (first word, number of words) of the windows found.
    Null and empty texts and items have no words and are never part of a hit; an item without id
    counts for hits but not as an item. Repeated rows get the same result each; an empty table
    on either side finds nothing. Other columns are not looked at.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"),
                             F.coalesce(F.col("text"), F.lit("")).alias("text"))
    windows = stored(
        map_batches(items, lambda b: _windows(b, window),
                    "item_id string, words array<string>, tokens array<long>"), "windows")
    distinct = windows.select("words", "tokens").distinct()
    placed = distinct.select(
        "words", F.posexplode("tokens").alias("shift", "token"),
        F.least(F.size("words"), F.lit(TOKEN_WORDS)).alias("token_size"))
    texts = doc_texts(docs)
    every = spark.sparkContext.broadcast(_bitmaps(placed.select("token", "token_size")))
    times = map_batches(texts.select("text"), lambda b: _count(b, every),
                        "token long, times long").groupBy("token").agg(F.sum("times").alias("times"))
    # A window with a token that no document contains occurs nowhere and leaves here.
    prefix = stored(
        placed.join(times, "token", "left").groupBy("words").agg(
            F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "token", "shift",
                           "token_size")).alias("rarest"))
        .filter("rarest.times > 0")
        .select("words", F.size("words").alias("size"), "rarest.token", "rarest.shift",
                "rarest.token_size"), "prefix-tokens")
    chosen = spark.sparkContext.broadcast(_bitmaps(prefix.select("token", "token_size")))
    probe = stored(map_batches(
        texts.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                     fingerprint(F.col("text")).alias("key_text"), "text"),
        lambda b: _probe(b, chosen, window), PROBE), "probe")

    start = F.col("at") - F.col("shift")
    candidates = probe.filter("token IS NOT NULL").join(prefix, "token") \
        .filter((start >= 0) & (start + F.col("size") <= F.col("n_words")))
    found = candidates.filter(
        F.slice("around", (start - F.col("first") + 1).cast("int"), F.col("size")) == F.col("words")) \
        .select("row", start.alias("start"), "size", "words")
    hits = found.join(windows.select("words", "item_id").distinct(), "words") \
        .groupBy("row").agg(
            F.collect_set(F.struct("start", "size")).alias("spans"),
            F.array_sort(F.collect_set("item_id")).alias("items"))
    word_numbers = F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1)))
    return probe.filter("token IS NULL").join(hits, "row", "left").select(
        "doc_id", "n_words",
        F.coalesce(F.array_size(F.array_distinct(word_numbers)), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.array_size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("spans").isNotNull().alias("contaminated"),
        "items", "spans", "key_text")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` in which no window of an item occurs, all columns kept."""
    found = stored(contamination(docs, benchmark).filter("contaminated").select(
        F.col("doc_id").alias("key_id"), "key_text"), "contaminated")
    return rows_of(docs, found, "left_anti")
