"""Line deduplication: lines that occur in many documents leave all of them.

Every text is split into lines, each line normalised to its key and the key hashed to 128 bits.
Distinct hashes of a document are exploded and counted per hash, with partial counts before the
shuffle. Lines with a hash at the threshold are joined back as (document, position), gathered to
the positions that a document drops, and the document is put together again from the positions
that stay. Built-in functions only; texts are shuffled at most once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.llm.frames import WHITE, doc_texts, fingerprint, sized
from tradewake.session import stored

LEAST_DOCUMENTS = 10
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    key = F.btrim(line, F.lit(WHITE))
    plain = F.octet_length(key) == F.char_length(key)  # then lower() changes A-Z alone, and is quick
    return F.when(plain, F.lower(key)).otherwise(F.translate(key, UPPER, UPPER.lower()))


def line_hashes(text: Column) -> Column:
    """Hash of every line's key in hex, null for an empty key.

    ``array_distinct`` compares all pairs of binary values, but looks up strings in a hash set.
    """
    def hashed(line):
        key = line_key(line)
        return F.when(key != "", F.md5(key.cast("binary")))
    return F.transform(lines_of(text), hashed)


def drop_frequent_lines(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (the text that stays): one row per row of ``docs``.

    A line's key is the line without white space at both ends and with A-Z in lower case. Lines
    whose key is not empty and occurs in at least ``least`` documents are dropped in all of
    them; each row is a document. Null and empty texts are one empty line, which stays. Rows equal
    in id and text get the same result each. An empty table gives an empty result; other columns
    are not looked at.
    """
    texts = doc_texts(docs).withColumn("key_text", fingerprint(F.col("text")))
    hashed = texts.select("doc_id", "key_text", line_hashes(F.col("text")).alias("hashes"))
    frequent = stored(
        # explode() would test the arrays' size first and so compute them twice.
        hashed.select(F.explode_outer(F.array_distinct("hashes")).alias("hash"))
        .filter("hash IS NOT NULL").groupBy(F.unhex("hash").alias("hash")).agg(F.count("*").alias("n"))
        .filter(F.col("n") >= least).select("hash"), "frequent-lines")
    places = hashed.select("doc_id", "key_text", F.posexplode_outer("hashes").alias("at", "hash")) \
        .filter("hash IS NOT NULL").withColumn("hash", F.unhex("hash")) \
        .join(sized(frequent), "hash", "left_semi")
    dropped = stored(places.groupBy("doc_id", "key_text").agg(F.collect_set("at").alias("dropped"))
                     .withColumnsRenamed({"doc_id": "key_id", "key_text": "of_text"}),
                     "dropped-lines")
    # As the argument of an outer transform the text is split once, not once for every line.
    gathered = F.transform(F.array(lines_of(F.col("text"))), lambda lines: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "dropped"),
                    lambda i: F.get(lines, i)), "\n"))
    kept = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.get(gathered, F.lit(0)))
    same = texts["doc_id"].eqNullSafe(F.col("key_id")) & (texts["key_text"] == F.col("of_text"))
    return texts.join(sized(dropped), same, "left").select(
        "doc_id", (F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
        .cast("long").alias("n_lines"),
        F.coalesce(F.array_size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept"))
