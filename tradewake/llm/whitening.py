"""Embedding whitening: exact cross-products from bit planes, components by eigendecomposition.

Entries become integers (``floor(256 * c)``). Every batch of vectors is sliced: a dimension is shifted
to its smallest value in the batch, and bit p of all its values is packed into 64-bit words, 64
vectors a word. The sum of products of two dimensions is then the sum over pairs of their planes
of 2^(p+q) times the number of common bits, an AND and a population count; the shift is undone with
the dimensions' own sums. Nothing is rounded, so neither order nor partitioning of the vectors
shows in the result. A task adds up its batches in whole numbers of any size and passes them on in
pieces of 32 bits, which Spark sums; the driver gets the sums of all pairs of dimensions, a size
that depends on the dimension alone. They are centred as integers before ``eigh`` sees them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.llm.frames import list_values
from tradewake.session import stored

SCALE = 256
PIECE = 32
# Variance below this share of the largest one is rounding of a dimension that does not vary.
LEAST_VARIANCE = 1e-10
SAFE = 1 << 62

RESULT = ("vec_id long, component int, n long, deviation long, whitened double, "
          "explained double, identity_error double")


def scaled(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of rows whose vector is neither null nor has null or non-finite entries."""
    entry = F.col(vector)
    bad = F.exists(entry, lambda c: c.isNull() | F.isnan(c.cast("double"))
                   | (F.abs(c.cast("double")) == float("inf")))
    return vectors.filter(entry.isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(entry, lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))


def rows_of(column: pa.Array, width: int) -> np.ndarray:
    offsets, values = list_values(column)
    return values[offsets[0]:offsets[-1]].reshape(-1, width)


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of all dimensions, and of products of all pairs of them (upper half), as Python integers."""
    rows, width = x.shape
    low = x.min(axis=0)
    shifted = x.astype(np.uint64) - low.astype(np.uint64)  # right modulo 2^64, also for far ends
    bits = [int(top).bit_length() for top in shifted.max(axis=0)]
    first = np.r_[0, np.cumsum(bits)]
    padded = -(-rows // 64) * 64
    planes = np.zeros((first[-1], padded // 8), np.uint8)
    for i in range(width):
        column = np.zeros(padded, np.uint64)
        column[:rows] = shifted[:, i]
        for p in range(bits[i]):
            planes[first[i] + p] = np.packbits((column >> np.uint64(p)).astype(np.uint8) & 1)
    planes = planes.view(np.uint64)
    kind = np.int64 if 2 * max(bits) + rows.bit_length() < 62 else object
    weight = np.array([1 << p for own in bits for p in range(own)], dtype=kind)
    sums = np.zeros(width, object)
    products = np.zeros((width, width), object)
    for i in range(width):
        others = [j for j in range(i, width) if bits[j]]
        for p in range(first[i], first[i + 1]):
            sums[i] += int(weight[p]) * int(np.bitwise_count(planes[p]).sum(dtype=np.int64))
            common = np.bitwise_count(planes[p] & planes[first[i]:]).sum(axis=1, dtype=np.int64)
            shares = np.add.reduceat(common.astype(kind) * weight[first[i]:], first[others] - first[i])
            products[i, others] += shares.astype(object) * int(weight[p])
    # Undo the shift: x = u + low in every dimension.
    low = low.astype(object)
    products += np.triu(np.outer(sums, low) + np.outer(low, sums) + rows * np.outer(low, low))
    return sums + rows * low, products


def pieces(value: int) -> Iterator[tuple[int, int]]:
    """A whole number as signed pieces: the sum of piece * 2^(32 * place)."""
    place = 0
    while value:
        part = value & ((1 << PIECE) - 1)
        if part >= 1 << (PIECE - 1):
            part -= 1 << PIECE
        if part:
            yield place, part
        value = (value - part) >> PIECE
        place += 1


def _sum_products(width: int):
    """Sums of a task's vectors, one row for each piece of a sum: (-1, -1) their number, (i, -1) x_i."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            sums, products = cross_products(rows_of(batch.column(0), width))
            for key, value in (("n", batch.num_rows), ("sums", sums), ("products", products)):
                total[key] = total.get(key, 0) + value
        if not total:
            return
        found = [(-1, -1, total["n"])]
        found += [(i, -1, total["sums"][i]) for i in range(width)]
        found += [(i, j, total["products"][i, j]) for i in range(width) for j in range(i, width)]
        rows = [(i, j, place, part) for i, j, value in found for place, part in pieces(int(value))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(),) * 3 + (pa.int64(),),
                                            strict=True)], names=["i", "j", "place", "part"])
    return run


@dataclass(frozen=True)
class Space:
    """What whitening learned: ``axes`` has a unit eigenvector per row, by falling ``variance``."""

    n: int
    sums: np.ndarray  # of Python integers
    axes: np.ndarray
    variance: np.ndarray
    total: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly: as int64 where that holds it, else as Python integers."""
        reach = self.n * int(max(abs(int(x.max())), abs(int(x.min())))) + max(map(abs, self.sums))
        if reach < SAFE:
            return self.n * x - self.sums.astype(np.int64)
        return self.n * x.astype(object) - self.sums

    def varying(self) -> np.ndarray:
        return self.variance > max(self.total, 0) * LEAST_VARIANCE / len(self.sums)

    def project(self, deviations: np.ndarray) -> np.ndarray:
        """Whitened coordinates; NaN for components without variance."""
        scale = np.where(self.varying(), np.sqrt(np.abs(self.variance)), np.nan)
        return (deviations.astype(np.float64) / self.n) @ self.axes.T / scale


def spread(deviations: np.ndarray) -> pa.Array:
    """Sum of squares of every row, null where a long cannot hold it."""
    top = np.abs(deviations).max(axis=1) if deviations.dtype != object else None
    if top is not None and len(top) and int(top.max()) ** 2 * deviations.shape[1] < SAFE:
        return pa.array((deviations ** 2).sum(axis=1))
    exact = [sum(int(d) ** 2 for d in row) for row in deviations]
    return pa.array([value if value < 1 << 63 else None for value in exact], pa.int64())


def learn(fit: DataFrame, width: int, components: int) -> Space:
    """The space of the distinct vectors (``x`` of ``width`` entries) of ``fit``."""
    sums = fit.select("x").mapInArrow(_sum_products(width), "i int, j int, place int, part long") \
        .groupBy("i", "j", "place").agg(F.sum("part").alias("part")).toArrow().to_pydict()
    exact = {}
    for i, j, place, part in zip(*(sums[k] for k in ("i", "j", "place", "part")), strict=True):
        exact[i, j] = exact.get((i, j), 0) + (part << (PIECE * place))
    n = exact[-1, -1]
    own = np.array([exact.get((i, -1), 0) for i in range(width)], object)
    centred = np.empty((width, width))
    for i in range(width):
        for j in range(i, width):
            centred[i, j] = centred[j, i] = (n * exact.get((i, j), 0) - own[i] * own[j]) / (n * n)
    variance, axes = np.linalg.eigh(centred)
    axes = axes[:, ::-1][:, :components].T
    variance = np.maximum(variance[::-1][:components], 0)
    turn = np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])
    return Space(n, own, axes * turn[:, None], variance, float(np.trace(centred)))


def _sum_whitened(space: Space):
    """Sums and products of the whitened coordinates of a task's vectors."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(space.axes)
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            if batch.num_rows:
                whitened = space.project(space.deviations(rows_of(batch.column(0), len(space.sums))))
                ones = np.c_[whitened, np.ones(len(whitened))]
                total += ones.T @ ones
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())],
            names=["i", "j", "part"])
    return run


def identity_error(fit: DataFrame, space: Space) -> float | None:
    """Largest absolute entry of the whitened coordinates' covariance minus the identity.

    It is measured on the vectors of ``fit``, over the components that vary; null without any.
    """
    kept = np.flatnonzero(space.varying())
    if not len(kept):
        return None
    parts = fit.select("x").mapInArrow(_sum_whitened(space), "i int, j int, part double") \
        .groupBy("i", "j").agg(F.sum("part").alias("part")).toArrow().to_pydict()
    size = len(space.axes)
    total = np.zeros((size + 1, size + 1))
    total[parts["i"], parts["j"]] = parts["part"]
    mean = total[kept, size] / space.n
    covariance = total[np.ix_(kept, kept)] / space.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(len(kept))).max())


def whiten(vectors: DataFrame, components: int = 4, vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error.

    Rows whose vector is null or has null or non-finite entries are dropped. The others are learned
    from, each distinct integer vector once, and each gives one row per component, numbered from 1
    by falling variance; there are as many as the vectors have dimensions, ``components`` at most. All vectors
    of a space have one length: that of most distinct vectors, then the greatest; rows of
    other lengths are dropped too. Repeated rows and null ids give their rows like any other. A
    component without variance (one vector alone, constant dimensions) has null ``whitened``, explains
    0, and does not count in the identity error, which is null if no component varies.
    ``deviation`` is null where a long cannot hold it. An empty table, or one of empty vectors,
    gives an empty result. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    usable = scaled(vectors, vector)
    fit = stored(usable.groupBy("x").agg(F.size("x").alias("width")), "whitening-fit")
    common = fit.filter("width > 0").groupBy("width").agg(F.count("*").alias("n")) \
        .orderBy(F.desc("n"), F.desc("width")).head()
    if common is None:
        return spark.createDataFrame([], RESULT)
    width = common["width"]
    fit = fit.filter(F.col("width") == width)
    space = learn(fit, width, components)
    error = identity_error(fit, space)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, varying = len(space.axes), space.varying()
        explained = space.variance / space.total if space.total > 0 else np.zeros(size)
        explained = np.where(varying, explained, 0.0)
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            deviations = space.deviations(rows_of(batch.column(1), width))
            at = np.repeat(np.arange(rows), size)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(at)),
                pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * size, space.n)),
                spread(deviations).take(pa.array(at)),
                pa.array(space.project(deviations).ravel(), mask=np.tile(~varying, rows)),
                pa.array(np.tile(explained, rows)),
                pa.array([error], pa.float64()).take(pa.array(np.zeros(rows * size, np.int64))),
            ], names=[part.split()[0] for part in RESULT.split(", ")])

    return usable.filter(F.size("x") == width).mapInArrow(run, RESULT)
