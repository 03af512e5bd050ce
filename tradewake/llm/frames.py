"""Small DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewake.operators.lookups import measured
from tradewake.session import stored

WHITE = " \t\n\x0b\x0c\r"
# Words of 64 bits in the bitmaps that are broadcast as tables.
BITMAP_WORDS = 1 << 19
# Spark hands tasks batches of so many bytes, not of so many rows alone: long texts make no large
# ones, whose copies in the JVM, in the worker and between them would stay allocated.
ARROW_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary_path() -> str:
    """Place of the public byte-level vocabulary that queries and pipeline use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of a session that has no bound of its own; no result depends on it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(ARROW_BYTES))


def doc_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) alone, null texts as empty: no other column can clash with an operator's."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def fingerprint(text: Column) -> Column:
    """128-bit hash of a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def map_batches(frame: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with a function from one record batch to record batches."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)
    return frame.mapInArrow(run, schema)


def rows_of(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` with (``left_semi``) or without (``left_anti``) a key.

    ``keys`` has the columns key_id and key_text (a fingerprint); rows with the same id and the
    same text share their fate, and a null id is a value like any other.
    """
    same = docs["doc_id"].cast("long").eqNullSafe(keys["key_id"]) & \
        (fingerprint(docs["text"]) == keys["key_text"])
    return docs.join(keys, same, how)


def sized(frame: DataFrame) -> DataFrame:
    """The frame, to be broadcast if its measured size is within the library's budget."""
    return F.broadcast(frame) if measured(frame).fits else frame


def identified(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text) with a number for every row that stays the same in all later reads.

    That is the doc_id where ids are unique and never null. Otherwise rows are numbered in a
    table of their own in the shared folder.
    """
    texts = doc_texts(docs)
    ids = texts.groupBy("doc_id").agg(F.count("*").alias("n")) \
        .filter("n > 1 OR doc_id IS NULL")
    if ids.isEmpty():
        return texts.select(F.col("doc_id").alias("row"), "doc_id", "text")
    return stored(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"),
                  "identified")


def list_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list column without nulls, as arrays."""
    return column.offsets.to_numpy(), column.values.to_numpy()


def bitmap(numbers: DataFrame, bits: int) -> np.ndarray:
    """Which of ``bits`` places, a power of two, the 64-bit numbers of a one-column frame hit.

    Its size is fixed: the driver gets at most one number for every 64 places.
    """
    place = F.col(numbers.columns[0]).bitwiseAND(bits - 1)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    parts = numbers.groupBy(F.shiftright(place, 6).alias("part")).agg(F.bit_or(one).alias("bits")) \
        .toArrow()
    found = np.zeros(bits // 64, np.int64)
    found[parts.column(0).to_numpy()] = parts.column(1).to_numpy()
    return found


def maybe_among(frame: DataFrame, number: Column, wanted: DataFrame) -> DataFrame:
    """Rows whose 64-bit number may be among those of the one-column frame ``wanted``.

    All rows whose number is there, and few others. The bitmap is broadcast and has ``BITMAP_WORDS`` words at
    most, whatever the input; a full one lets every row pass to the exact join that follows.
    """
    def word(value: Column) -> Column:
        return F.shiftrightunsigned(value, 6).bitwiseAND(BITMAP_WORDS - 1)

    theirs = F.col(wanted.columns[0])
    one = F.call_function("shiftleft", F.lit(1).cast("long"), theirs.bitwiseAND(63).cast("int"))
    words = wanted.groupBy(word(theirs).alias("bitmap_word")).agg(F.bit_or(one).alias("bitmap_bits"))
    found = frame.withColumn("bitmap_number", number)
    bit = F.call_function("shiftrightunsigned", F.col("bitmap_bits"),
                          F.col("bitmap_number").bitwiseAND(63).cast("int"))
    return found.join(F.broadcast(words), word(F.col("bitmap_number")) == F.col("bitmap_word")) \
        .filter(bit.bitwiseAND(1) == 1).drop("bitmap_number", "bitmap_word", "bitmap_bits")


def may_be(found: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """False for numbers that surely are not among those of the bitmap."""
    place = numbers & (len(found) * 64 - 1)
    return (found[place >> 6] >> (place & 63)) & 1 == 1
