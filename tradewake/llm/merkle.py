"""Merkle manifest: hash trees over the rows of every source, and over the sources.

A row's leaf is the hash of its fields. The leaves of a source, in order of their ids, are hashed
in runs of ``arity`` until one node is left, its subroot; the subroots, in order of their
sources, are hashed the same way to the root.

Nodes of a level are rows (tree, index, digest). Each level joins every node with the others of its
run by their computed indices (the slot's offsets within the run; with two slots that is index XOR
1), and the rows in slot zero then emit the parents. A level is a table of its own, a third of
the one below; going down again, every node prepends its siblings to the path of its
parent. So no step sees more than one run, however many rows a source has, and paths reach the
leaves through equijoins only. Leaves get their indices without gathering a source anywhere: rows
are range-partitioned and sorted, numbered inside the partition, and moved on by the sizes of earlier
partitions. Built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewake.llm.frames import sized
from tradewake.session import stored

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NOTHING = b""


def digest(*parts: Column) -> Column:
    """SHA-256 of the concatenated parts, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def spelled(node: Column) -> Column:
    return F.lower(F.hex(node))


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column) -> Column:
    """Digest of a row's fields, with this text."""
    return digest(*(field(text if name == "text" else F.col(name)) for name in FIELDS))


def ordered_key(source: Column) -> Column:
    """Source as a key that is never null and sorts like it, null first."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("-"))


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, their place in their tree from 0, and ``n``, the size of the tree.

    Rows are dealt to partitions by ranges of (tree, order) and, should these be equal for many, of
    their place in the input: a tree of any size spreads over many partitions. Only one row per
    tree and partition is counted again.
    """
    order = [tree, *order, "input_place"]
    dealt = stored(rows.withColumn("input_place", F.monotonically_increasing_id())
                   .repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("place", F.monotonically_increasing_id()), "merkle-ranges")
    part = F.shiftright("place", 33).alias("part")  # partition, above 33 bits of row number
    sums = W.partitionBy(tree)
    parts = dealt.groupBy(tree, part).agg(F.count("*").alias("own"), F.min("place").alias("least"))
    parts = parts.select(
        F.col(tree).alias("tree_"), F.col("part").alias("part_"), "least",
        F.coalesce(F.sum("own").over(sums.orderBy("part").rowsBetween(W.unboundedPreceding, -1)),
                   F.lit(0)).alias("before"),
        F.sum("own").over(sums).alias("n"))
    found = dealt.withColumn("part", part).join(
        sized(stored(parts, "merkle-parts")),
        (F.col(tree) == F.col("tree_")) & (F.col("part") == F.col("part_")))
    return found.select(*rows.columns, (F.col("place") - F.col("least") + F.col("before")).alias("at"), "n")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Every node with the digests of the others of its run: ``left`` and ``right`` of it, in order.

    One equijoin for each of the other slots, on the index that the node computes for it.
    """
    joined = nodes.withColumn("slot", F.pmod("at", F.lit(arity)).cast("int"))
    for step in range(1, arity):
        other = (F.col("slot") + step) % arity
        theirs = nodes.select(F.col("tree").alias("tree_"), F.col("at").alias("at_"),
                              F.col("node").alias(f"other{step}"))
        joined = joined.withColumn("wanted", F.col("at") - F.col("slot") + other) \
            .join(theirs, (F.col("tree") == F.col("tree_")) & (F.col("wanted") == F.col("at_")), "left") \
            .drop("tree_", "at_", "wanted")

    def slot_of(slot: int) -> Column:
        """Digest in a slot of the run, empty for the node's own and for slots that are not there."""
        found = F.lit(NOTHING)
        for step in range(1, arity):
            found = F.when((F.col("slot") + step) % arity == slot,
                           F.coalesce(F.col(f"other{step}"), F.lit(NOTHING))).otherwise(found)
        return found

    def side(own: Column) -> Column:
        return F.concat(*(F.when(own(F.lit(s)), slot_of(s)).otherwise(F.lit(NOTHING))
                          for s in range(arity)))
    return joined.select("tree", "at", "n", "slot", "node",
                         side(lambda s: s < F.col("slot")).alias("left"),
                         side(lambda s: s > F.col("slot")).alias("right"))


def grow(leaves: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """All levels of every tree, and the root of each.

    ``leaves`` has tree, at, n and node. A level has (tree, at, n, slot, node, left, right) of
    the trees with more than one node there; roots are (tree, node).
    """
    most = leaves.agg(F.max("n")).head()[0] or 0
    nodes, levels, roots = leaves.select("tree", "at", "n", "node"), [], []
    while True:
        roots.append(nodes.filter("n = 1").select("tree", "node"))
        if most <= 1:
            return levels, stored(reduce(DataFrame.unionAll, roots), "merkle-roots")
        levels.append(stored(with_siblings(nodes.filter("n > 1"), arity), "merkle-level"))
        nodes = levels[-1].filter("slot = 0").select(
            "tree", F.expr(f"at div {arity}").alias("at"),
            F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            digest(spelled(F.col("node")), spelled(F.col("right"))).alias("node"))
        most = -(-most // arity)


NO_STEPS = "array<struct<left:binary,right:binary>>"


def descend(leaves: DataFrame, levels: list[DataFrame], above: DataFrame,
            arity: int = ARITY) -> DataFrame:
    """``leaves`` with their ``path``: the siblings to the left and right, level by level up to the root.

    ``above`` has a row per tree: the path that continues behind its root, and columns
    that all its leaves inherit. A level's paths are a table, read for the next level only.
    """
    inherited = [c for c in above.columns if c not in ("tree", "path")]
    path = None
    for level in reversed(levels):
        own = level.select("tree", "at", F.expr(f"at div {arity}").alias("up"), "n",
                           F.array(F.struct("left", "right")).alias("step"))
        # The parent of so few nodes is their tree's root.
        found = own.filter(F.col("n") <= arity).drop("up").join(above, "tree")
        if path is not None:
            found = found.unionByName(own.filter(F.col("n") > arity).join(
                path.withColumnRenamed("at", "up"), ["tree", "up"]).drop("up"))
        path = stored(found.select("tree", "at", F.concat("step", "path").alias("path"), *inherited),
                      "merkle-paths")
    alone = leaves.filter("n = 1").join(above, "tree")
    return alone if path is None else alone.unionByName(
        leaves.filter("n > 1").join(path, ["tree", "at"]))


def fold(node: Column, path: Column) -> Column:
    """The root that a node and its siblings, level by level, hash to."""
    return F.aggregate(path, node, lambda at, step: digest(
        spelled(step["left"]), spelled(at), spelled(step["right"])))


def proof(path: Column) -> Column:
    """SHA-256 of all siblings of a path, in order, in hex."""
    return F.sha2(F.aggregate(path, F.lit(""), lambda at, step: F.concat(
        at, spelled(step["left"]), spelled(step["right"]))).cast("binary"), 256)


def tampered(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is even; a null id's row is never changed."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def manifest(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per row of ``docs``.

    Rows of a source are ordered by doc_id (null first), then by their leaf: rows equal in all
    fields are a leaf each, and interchangeable. Null sources are a source of their own, the first. Null
    and empty texts have different leaves. Where ``tampered`` says so, the row is checked with
    the line breaks of its text deleted; others are checked as they are. ``verified`` says
    whether the checked leaf and the siblings of the original hash to the root. An empty table
    gives an empty result; columns other than the five fields are not looked at.
    """
    text = F.col("text")
    changed = F.when(tampered(F.col("doc_id")), F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    fields = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *FIELDS[1:])
    leaves = fields.select("doc_id", ordered_key(F.col("source")).alias("tree"),
                           leaf(text).alias("node"), leaf(changed).alias("checked"))
    leaves = stored(numbered(leaves, "tree", ["doc_id", "node"]), "merkle-rows")
    levels, subroots = grow(leaves, arity)
    # The trees' roots are the leaves of one more tree, which has no name.
    tops = stored(numbered(subroots.select(F.lit("").alias("all"), F.col("tree").alias("of"), "node"),
                           "all", ["of"]).withColumnRenamed("all", "tree"), "merkle-tops")
    top_levels, root = grow(tops, arity)
    end = root.select("tree", F.array().cast(NO_STEPS).alias("path"), F.col("node").alias("root"))
    above = stored(descend(tops, top_levels, end, arity).select(
        F.col("of").alias("tree"), "path", F.col("node").alias("subroot"), "root"), "merkle-above")
    return descend(leaves, levels, above, arity).select(
        "doc_id", spelled(F.col("node")).alias("leaf"), spelled(F.col("subroot")).alias("subroot"),
        spelled(F.col("root")).alias("root"), proof(F.col("path")).alias("proof_sha256"),
        spelled(fold(F.col("checked"), F.col("path"))).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))
