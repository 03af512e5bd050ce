"""Exact deduplication: groups of a 128-bit content hash, bytes compared inside the groups.

Texts are equal when identical after deleting ASCII white space. A first pass keeps only ids,
hashes and lengths. Texts are read again for rows whose hash occurs more than once, and are
grouped by hash *and* text, so grouping itself compares the bytes; partial aggregation leaves one
row per task of a large group of copies. A bitmap of fixed size keeps most other texts out of the
shuffle that brings texts to the repeated hashes. The small table of group results is joined
back to the narrow rows. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.llm.frames import WHITE, doc_texts, fingerprint, maybe_among, rows_of
from tradewake.session import stored

# A hash that occurs often is looked up under so many keys, which spreads the texts of its rows.
SPREAD = 8


def normal_text(text: Column) -> Column:
    for char in WHITE:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_groups(docs: DataFrame,
                 content: Callable[[Column], Column] = content_hash) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``.

    Of equal texts the row with the most code points stays, then the smallest doc_id (null
    sorts first), then one of the rows that are equal in both. Null counts as empty, and all
    empty texts are one group. An empty table gives an empty result. Other columns of ``docs``
    are not looked at. ``content`` may be any hash: rows it does not tell apart are told
    apart by their bytes and named by their SHA-256; texts that agreed in both hashes but not
    in their bytes would stop the job instead of being taken for copies.
    """
    texts = doc_texts(docs).withColumn("same", normal_text(F.col("text"))) \
        .withColumn("hash", content(F.col("same")))
    narrow = stored(texts.select(
        "doc_id", "hash", F.sha2(F.col("same"), 256).alias("text_sha256"),
        F.char_length("text").alias("chars"), F.monotonically_increasing_id().alias("row"),
        fingerprint(F.col("text")).alias("key_text")), "exact-narrow")
    repeated = stored(narrow.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1")
                      .select("hash"), "exact-repeated")
    keys = repeated.select("hash", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"))
    copies = maybe_among(texts, F.xxhash64("hash"), repeated.select(F.xxhash64("hash"))) \
        .withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)).cast("int")) \
        .join(keys, ["hash", "part"], "left_semi")
    by_bytes = copies.groupBy("hash", F.sha2(F.col("same"), 256).alias("text_sha256"), "same") \
        .agg(F.count("*").alias("n"))
    groups = by_bytes.groupBy("hash", "text_sha256").agg(
        F.when(F.count("*") == 1, F.sum("n"))
        .otherwise(F.raise_error(F.lit("different texts agree in both hashes")))
        .alias("group_size"))
    best = narrow.groupBy("hash", "text_sha256").agg(
        F.min(F.struct((-F.col("chars")).alias("less"), "doc_id", "row")).alias("best"))
    groups = stored(groups.join(best, ["hash", "text_sha256"]), "exact-groups")
    return narrow.join(groups, ["hash", "text_sha256"], "left").select(
        "doc_id",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("best.row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256", "key_text")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every group of equal texts, all columns kept."""
    kept = stored(exact_groups(docs).filter("kept").select(
        F.col("doc_id").alias("key_id"), "key_text"), "exact-kept")
    left = rows_of(docs, kept, "left_semi")
    # Rows equal in id and text pass together; they are few, and one of them stays.
    again = stored(docs.groupBy(F.col("doc_id").cast("long").alias("key_id"),
                                fingerprint(F.col("text")).alias("key_text"))
                   .agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "exact-again")
    once = rows_of(left, again, "left_anti")
    more = rows_of(left, again, "left_semi")
    return once.unionByName(more.dropDuplicates(["doc_id", "text"]))
