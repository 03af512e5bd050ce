"""Exact Jaccard join of shingle sets, with answers derived from similar sets.

Equal sets are one class. A class enters with the prefix of its rarest shingles that any similar
set must share. Rarity comes from a sketch of fixed size that counts the shingles of all documents;
any order gives the same links, a rare-first one gives short lists. Then:

1. Of every list (the classes with one prefix shingle) the smallest class is the leader, and each
   class is compared with its leaders. A class similar enough to a leader has it as its *hub*.
2. Lists are joined with themselves only for classes of different hubs; entries whose size or
   position in the two sets rules out the wanted overlap are skipped.
3. Classes of one hub: those that link with the hub share its component and need no comparison
   among each other. The others are compared with the members of the hub in blocks. There the
   overlaps of a set are not counted anew but derived from the overlaps of its hub, by the lists of
   the few shingles in which set and hub differ; lists are ordered by set size, and the part of a
   list whose sizes cannot reach the threshold is skipped.

Steps 2 and 3 lose no link: two linked classes share a prefix shingle, so they meet in a list, and
they have either different hubs or the same one. Only links that connect are passed on, never
all pairs of a group. A document is one row; components are of documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewake.llm.components import components
from tradewake.llm.flat import NOT_SPACE, row_ranges, shingles, text_buffers, words
from tradewake.llm.frames import (bounded_batches, doc_texts, fingerprint, map_batches, maybe_among,
                                   rows_of, sized)
from tradewake.session import stored

BATCH_BYTES = 1 << 20
# The sketch has 2 ** BUCKET_BITS counters, added up in PARTS pieces.
BUCKET_BITS, PARTS = 20, 64
BUCKETS = 1 << BUCKET_BITS
# A shingle that occurs more often has its list cut into pieces, numbered from 1; each piece has its
# own leader.
LONG_LIST, PIECES = 1 << 22, 64
# Shingles of a block of sets that are compared with another block in one task.
BLOCK = 1 << 18
# Prefix shingles that a set shares with a leader, or with sets of a hub, before it is compared with it;
# fewer for short prefixes. A matter of effort: pairs not tried here are found in step 2.
TRIED_FROM, TRIED_AGAIN_FROM = 4, 2
# Linked sets share at least this many prefix shingles, where prefixes are that much longer: one, and
# one more for every SHARED_PER shingles of the smaller set up to MOST_SHARED. So large sets that
# share a few shingles by chance are never compared, and small ones do not reach common shingles.
SHARED_PER, MOST_SHARED = 64, 4


def sets_of(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of every text; no shingle without words."""
    data, offsets = text_buffers(texts)
    for first, last in row_ranges(offsets, BATCH_BYTES):
        hashes, _, _, counts = words(data[offsets[first]:offsets[last]],
                                     offsets[first:last + 1] - offsets[first], NOT_SPACE)
        values, _, own = shingles(hashes, counts, size)
        ends = np.cumsum(own)
        for row, (begin, end) in enumerate(zip(ends - own, ends, strict=True)):
            yield first + row, np.unique(values[begin:end])


def set_id(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _describe(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """A row for every document, and the task's part of the sketch."""
    names = ["doc_id", "key_text", "n", "sid", "part", "counts"]
    sketch = np.zeros(BUCKETS, np.int64)  # a task's own counts are small
    for batch in batches:
        n, sid = [], []
        for _, tokens in sets_of(batch.column(2), size):
            n.append(len(tokens))
            sid.append(set_id(tokens))
            np.add.at(sketch, _bucket(tokens), 1)
        none = len(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sid, pa.binary()),
             pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())], names=names)
    pieces = [p.tobytes() for p in sketch.astype(np.int32).reshape(PARTS, -1)]
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(PARTS, pa.int64()), pa.nulls(PARTS, pa.binary()), pa.nulls(PARTS, pa.int64()),
         pa.nulls(PARTS, pa.binary()), pa.array(range(PARTS), pa.int32()),
         pa.array(pieces, pa.binary())], names=names)


def _add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            values = np.frombuffer(counts.as_buffer(), np.int32).astype(np.int64)
            sums[part] = sums[part] + values if part in sums else values
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
        names=["part", "counts"])


def _sketch(described: DataFrame) -> np.ndarray:
    """Counters of all documents' shingles: BUCKETS numbers on the driver, whatever the input."""
    parts = described.filter("part IS NOT NULL").select("part", "counts").repartition("part") \
        .mapInArrow(_add_up, "part int, counts binary").collect()
    total = np.zeros((PARTS, BUCKETS // PARTS), np.int64)
    for row in parts:
        total[row["part"]] += np.frombuffer(bytes(row["counts"]), np.int64)
    return total.reshape(-1)


def _prefixes(batches: Iterable[pa.RecordBatch], size: int, num: int, den: int,
              sketch, long_list: int) -> Iterator[pa.RecordBatch]:
    """Prefix shingles of every set; a set that occurs again within the task is left out."""
    counts, seen = sketch.value, set()
    for batch in batches:
        token, salt, sid, n, pos = [], [], [], [], []
        for _, tokens in sets_of(batch.column(0), size):
            own = set_id(tokens)
            if not len(tokens) or own in seen:
                continue
            seen.add(own)
            often = counts[_bucket(tokens)]
            length = len(tokens) + (-num * len(tokens)) // den + min(1 + len(tokens) // SHARED_PER, MOST_SHARED)
            order = np.lexsort((tokens, often))[:length]
            token.append(tokens[order].view(np.int64))
            salt.append(np.where(often[order] > long_list, 1 + own[0] % PIECES, 0))
            sid += [own] * len(order)
            n.append(np.full(len(order), len(tokens)))
            pos.append(np.arange(len(order)))
        if token:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(token)), pa.array(np.concatenate(salt), pa.int32()),
                 pa.array(sid, pa.binary()), pa.array(np.concatenate(n), pa.int32()),
                 pa.array(np.concatenate(pos), pa.int32())],
                names=["token", "salt", "sid", "n", "pos"])


def _overlaps(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Set sizes and overlap of pairs of texts; a text that follows itself is taken apart once."""
    n, m, overlap, last, other = [], [], [], None, None
    for (_, own), b, text in zip(sets_of(batch.column(2), size), batch.column(1).to_pylist(),
                                 batch.column(3), strict=True):
        if b != last:
            (_, other), = sets_of(pa.array([text.as_py()]), size)
            last = b
        n.append(len(own))
        m.append(len(other))
        overlap.append(len(np.intersect1d(own, other, True)))
    yield pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), *(pa.array(v, pa.int32()) for v in (n, m, overlap))],
        names=["a", "b", "n", "m", "overlap"])


def derived_links(hub: np.ndarray, outer: list[np.ndarray], members: list[np.ndarray],
                  num: int, den: int) -> list[tuple[int, int]]:
    """Links of ``outer`` sets with ``members``, without those that connect nothing new.

    Overlaps with the hub are counted once. Those of an outer set follow from them by the lists of
    the shingles that only one of hub and set has.
    """
    sizes = np.array([len(m) for m in members], np.int64)
    by_size = np.argsort(sizes, kind="stable")
    sizes = sizes[by_size]
    m = len(members)
    tokens = np.concatenate([members[i] for i in by_size])
    vocabulary, code = np.unique(tokens, return_inverse=True)
    # A list entry is its shingle's number times m plus the member's place by size.
    entries = np.sort(code.astype(np.int64) * m + np.repeat(np.arange(m), sizes))
    places = entries % m

    def counted(wanted: np.ndarray, low: int, high: int) -> np.ndarray:
        at = np.searchsorted(vocabulary, wanted)
        at[at == len(vocabulary)] = 0
        at = at[vocabulary[at] == wanted]
        begin = np.searchsorted(entries, at * m + low)
        length = np.searchsorted(entries, at * m + high) - begin
        ends = np.cumsum(length)
        if not len(ends) or not ends[-1]:
            return np.zeros(m, np.int64)
        picked = np.repeat(begin - (ends - length), length) + np.arange(ends[-1])
        return np.bincount(places[picked], minlength=m)

    base = counted(hub, 0, m)
    parent = {}

    def root(node):
        while parent.setdefault(node, node) != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    links = []
    for i, own in enumerate(outer):
        low = int(np.searchsorted(sizes, -(-num * len(own) // den)))
        high = int(np.searchsorted(sizes, den * len(own) // num, "right"))
        if low >= high:
            continue
        overlap = base + counted(np.setdiff1d(own, hub, True), low, high) \
            - counted(np.setdiff1d(hub, own, True), low, high)
        linked = (den + num) * overlap >= num * (len(own) + sizes)
        linked[:low] = linked[high:] = False
        for place in np.flatnonzero(linked):
            j = int(by_size[place])
            a, b = root(("o", i)), root(("m", j))
            if a != b:
                parent[a] = b
                links.append((i, j))
    return links


def _within_hub(table: pa.Table, size: int, num: int, den: int) -> pa.Table:
    sids, roles = table.column("sid").to_pylist(), table.column("role").to_pylist()
    sets = [tokens for _, tokens in sets_of(table.column("text").combine_chunks(), size)]
    hub, outer, members = ([i for i, own in enumerate(roles) if own == role] for role in (0, 1, 2))
    a, b = [], []
    if hub and outer and members:
        for i, j in derived_links(sets[hub[0]], [sets[i] for i in outer], [sets[j] for j in members], num, den):
            a.append(sids[outer[i]])
            b.append(sids[members[j]])
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _similar(n: Column, m: Column, overlap: Column, num: int, den: int) -> Column:
    return overlap.cast("long") * (num + den) >= (n.cast("long") + m) * num


def jaccard_components(docs: DataFrame, size: int = 5, num: int = 4, den: int = 5,
                       long_list: int = LONG_LIST) -> DataFrame:
    """doc_id, n_shingles, component_id, first, key_text: one row per row of ``docs``.

    A document's set are its distinct shingles of ``size`` words, lower-cased in A-Z; with fewer
    words the whole sequence is the only one. Documents link when the overlap of their sets is at
    least ``num / den`` of their union. ``component_id`` is the smallest doc_id reachable by links,
    itself included; ``first`` marks the row it names. Null and empty texts and texts without words have no shingles, link with
    nothing and are their own component. Repeated rows are documents with equal sets; a null
    doc_id is never the smallest. An empty table gives an empty result; other columns are not
    looked at. Shingles are compared as 64-bit hashes.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = doc_texts(docs).withColumn("key_text", fingerprint(F.col("text")))
    described = stored(
        texts.select("doc_id", "key_text", "text").mapInArrow(
            lambda batches: _describe(batches, size),
            "doc_id long, key_text binary, n long, sid binary, part int, counts binary"),
        "described")
    rows = described.filter("part IS NULL").select("doc_id", "key_text", "n", "sid")
    sketch = spark.sparkContext.broadcast(_sketch(described))

    same_list = Window.partitionBy("token", "salt")
    entries = texts.select("text").mapInArrow(
        lambda batches: _prefixes(batches, size, num, den, sketch, long_list),
        "token long, salt int, sid binary, n int, pos int") \
        .repartition("token", "salt").dropDuplicates(["token", "salt", "sid"])
    pieces = entries.withColumn("members", F.count("*").over(same_list)) \
        .withColumn("leader", F.min(F.struct("sid", "n")).over(same_list))
    columns = ("token", "sid", "n", "pos", "leader")
    if sketch.value.max() > long_list:
        # A set alone in its piece stays if its list has other pieces: step 2 joins whole lists.
        pieces = stored(pieces.filter("members > 1 OR salt > 0"), "pieces")
        whole = pieces.filter("salt > 0").groupBy("token").agg(F.count("*").alias("sets")) \
            .filter("sets > 1").select("token")
        alone = stored(pieces.filter("members = 1").join(whole, "token", "left_semi").select(*columns), "alone")
        lists = pieces.filter("members > 1").select(*columns).unionByName(alone)
    else:
        lists = stored(pieces.filter("members > 1").select(*columns), "lists")

    def must_share(n: Column) -> Column:
        return F.ceil(n * num / den)

    # Which leaders are tried is a matter of effort alone; step 2 misses none that was not tried.
    def shared(n: Column) -> Column:
        return F.least(1 + F.floor(n / SHARED_PER), F.lit(MOST_SHARED))

    m = F.col("leader.n")
    prefix = F.least("n", m) - must_share(F.least("n", m)) + shared(F.least("n", m))
    to_leader = stored(
        lists.filter((F.col("sid") != F.col("leader.sid")) & (F.least("n", m) * 2 >= F.greatest("n", m)))
        .groupBy(F.col("sid").alias("a"), F.col("leader.sid").alias("b"), prefix.alias("prefix"))
        .agg(F.count("*").alias("common")).filter(f"3 * common >= least(prefix, {3 * TRIED_FROM})")
        .select("a", "b"), "to-leader")

    first = rows.groupBy("sid").agg(F.min(F.struct("doc_id", "key_text")).alias("one"))

    def class_texts(pairs: DataFrame) -> DataFrame:
        """(sid, text) of the classes in pairs (a, b): texts compress better than shingles.

        Not stored: the exchange by set that ends it serves the joins that follow, on both sides.
        """
        needed = pairs.select(F.col("a").alias("sid")).unionAll(pairs.select("b")).distinct()
        keys = stored(first.join(needed, "sid", "left_semi").select(
            "sid", F.col("one.doc_id").alias("class_id"), F.col("one.key_text").alias("class_text")),
            "class-keys")
        # Of other documents few pass the bitmap: only texts that are needed are shuffled.
        near = maybe_among(texts, F.xxhash64("doc_id", "key_text"),
                           keys.select(F.xxhash64("class_id", "class_text")))
        same = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key_text") == F.col("class_text"))
        return near.join(sized(keys), same).select("sid", "text").dropDuplicates(["sid"])

    def compared(pairs: DataFrame, own: DataFrame) -> DataFrame:
        """(a, b, n, m, overlap) of pairs of classes."""
        one = own.select(F.col("sid").alias("a"), F.col("text").alias("x"))
        two = own.select(F.col("sid").alias("b"), F.col("text").alias("y"))
        return map_batches(pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y"),
                           lambda batch: _overlaps(batch, size),
                           "a binary, b binary, n int, m int, overlap int")

    own_texts = class_texts(to_leader)
    linked = _similar(F.col("n"), F.col("m"), F.col("overlap"), num, den)

    def found_hubs(star: DataFrame) -> DataFrame:
        return star.filter("3 * overlap >= n + m").groupBy(F.col("a").alias("sid"), "n") \
            .agg(F.min(F.struct("b", "linked")).alias("best")) \
            .select("sid", "n", F.col("best.b").alias("hub"), F.col("best.linked").alias("inner"))

    def with_hubs(hubs: DataFrame) -> DataFrame:
        """The list entries with their set's hub, itself if it has none, where hubs meet."""
        placed = lists.join(hubs.select("sid", "hub"), "sid", "left").select(
            "token", "sid", "n", "pos", F.coalesce("hub", "sid").alias("hub"))
        mixed = placed.groupBy("token", "hub").agg(F.count("*").alias("sets")).groupBy("token") \
            .agg(F.count("*").alias("hubs"), F.max(F.struct("sets", "hub")).alias("main")) \
            .filter("hubs > 1").select("token", F.col("main.hub").alias("main"))
        return placed.join(mixed, "token")

    star = stored(compared(to_leader, own_texts), "star").withColumn("linked", linked)
    hubs = stored(found_hubs(star), "hubs")
    # A set without hub is also tried with the main hub of its neighbours, which its lists may lack.
    again = stored(
        with_hubs(hubs).filter((F.col("hub") == F.col("sid")) & (F.col("main") != F.col("sid")))
        .groupBy(F.col("sid").alias("a"), F.col("main").alias("b")).agg(F.count("*").alias("common"))
        .filter(F.col("common") >= TRIED_AGAIN_FROM).select("a", "b")
        .join(hubs.select(F.col("hub").alias("b")).distinct(), "b", "left_semi")
        .join(to_leader, ["a", "b"], "left_anti"), "tried-again")
    star = star.unionByName(stored(compared(again, class_texts(again)), "star-again")
                            .withColumn("linked", linked))
    hubs = stored(found_hubs(star), "hubs")
    # A list falls into blocks of sets of similar size. Two sets can only link if they are in the same
    # block or in neighbouring ones: other pairs of blocks are skipped. (Skipping blocks by position as
    # well would skip none: prefixes are no longer than the positions of linked sets may differ.)
    placed = stored(with_hubs(hubs).drop("main").withColumn("block", F.floor(
        F.log(F.col("n")) / float(np.log(den / num) + 1e-9)).cast("int")), "placed")
    other = placed.select("token", F.explode(F.array(F.col("block"), F.col("block") - 1)).alias("block"),
                          *(F.col(c).alias(f"{c}2") for c in ("sid", "n", "pos", "hub")))
    rest = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2")) + F.least("pos", "pos2")
    across = stored(
        placed.join(other, ["token", "block"]).filter(
            (F.struct("n", "sid") < F.struct(F.col("n2").alias("n"), F.col("sid2").alias("sid"))) & (F.col("hub") != F.col("hub2")) &
            (F.col("n").cast("long") * den >= F.col("n2").cast("long") * num) &
            _similar(F.col("n"), F.col("n2"), rest, num, den))
        .groupBy(F.col("sid").alias("a"), F.col("sid2").alias("b"), F.least("n", "n2").alias("smaller"))
        .agg(F.count("*").alias("common")).filter(F.col("common") >= shared(F.col("smaller")))
        .select("a", "b"), "across")
    crossing = compared(across, class_texts(across)).filter(linked)

    outer_size = F.when(~F.col("inner"), F.col("n")).otherwise(0)
    counted = stored(hubs.groupBy("hub").agg(
        F.sum("n").alias("members"), F.sum(outer_size).alias("outer")).filter("outer > 0")
        .select("hub", *(F.ceil(F.col(c) / BLOCK).cast("int").alias(c)
                         for c in ("members", "outer"))), "hub-sizes")
    member = hubs.join(counted, "hub")
    block = F.pmod(F.xxhash64("sid"), F.col("members")).cast("int")
    outer_block = F.pmod(F.xxhash64("sid"), F.col("outer")).cast("int")
    all_outer = F.explode(F.sequence(F.lit(0), F.col("outer") - 1))
    all_members = F.explode(F.sequence(F.lit(0), F.col("members") - 1))
    cells = member.select("hub", "sid", F.lit(2).alias("role"), block.alias("j"), all_outer.alias("i")) \
        .unionByName(member.filter(~F.col("inner")).select(
            "hub", "sid", F.lit(1).alias("role"), outer_block.alias("i"), all_members.alias("j"))) \
        .unionByName(counted.withColumn("i", all_outer).select(
            "hub", F.col("hub").alias("sid"), F.lit(0).alias("role"), "i", all_members.alias("j")))
    texts_of_hubs = class_texts(hubs.join(counted, "hub", "left_semi").select(
        F.col("sid").alias("a"), F.col("hub").alias("b")))
    inside = cells.join(texts_of_hubs, "sid").groupBy("hub", "i", "j").applyInArrow(
        lambda table: _within_hub(table, size, num, den), "a binary, b binary")

    links = star.filter("linked").select("a", "b") \
        .unionAll(crossing.select("a", "b")).unionAll(inside)
    joined = components(links)
    # Of a group the row with the smallest id stands for it; a null id comes after all others.
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key_text")
    smallest = rows.groupBy("sid").agg(F.min(own).alias("own"))
    named = joined.join(smallest.withColumnRenamed("sid", "node"), "node") \
        .groupBy("label").agg(F.min("own").alias("least"))
    by_set = stored(smallest.join(
        joined.join(named, "label").select(F.col("node").alias("sid"), "least"), "sid", "left")
        .select("sid", F.coalesce("least", "own").alias("least")), "by-set")
    empty = F.col("n") == 0
    return rows.join(by_set, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        (empty | (F.col("doc_id").eqNullSafe(F.col("least.doc_id"))
                  & (F.col("key_text") == F.col("least.key_text")))).alias("first"), "key_text")


def drop_near_copies(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """``docs`` with one row of every component, all columns kept.

    The row with the component's smallest doc_id stays, or of several with that id the one with the
    smallest fingerprint; rows equal in id and text stay together. Texts without words stay.
    """
    out = stored(jaccard_components(docs, size, num, den).filter("NOT first")
                 .select(F.col("doc_id").alias("key_id"), "key_text").distinct(), "near-copies")
    return rows_of(docs, out, "left_anti")
