"""Versioned tables of dated rows: a few sorted files, a manifest, and an index of keys.

A version is a manifest: the table's files with their rows and days, and its index files with the
range of key hashes in them. Data files are never changed. A commit writes new files, then a
manifest under the next number, and the manifest appears by one rename. So a reader sees all
of a commit or nothing, and of two writers that began from the same version the second is
refused. Readers take files and schema from the manifest: no folder is listed, no schema inferred,
and days that are not asked for are not opened.

The index has a row (hash of the key, day) for every row, sorted by hash, so that an increment finds
the days that hold old copies of its keys by opening index files in the range of its hashes
only. A hash or an index row too many costs a file read, never a wrong result: rows are told apart by
the key itself.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewake.operators.lookups import BROADCAST_BUDGET, Lookup
from tradewake.operators.lookups import measured as measured_lookup
from tradewake.session import stored
from tradewake.sources import files

# A file of fewer rows is small; beyond so many of them, a commit gathers them into one.
SMALL_ROWS = 1_000_000
MOST_SMALL_FILES = 32
# Index rows per file, and the leading bits of a hash by which increments choose index files.
INDEX_ROWS = 1_000_000
HASH_BITS = 12
SHIFT = 64 - HASH_BITS
INDEX = "hash long, day date"
NO_SOURCES: Mapping[str, int] = {}
# With so many days replaced, the new rows are dealt to several files.
FEW_DAYS = 1000
# What looked up keys take in a broadcast: a hash at most, and rows of them, for which the driver holds
# a table with each row as key and as value, and its slots, beside the rows it was made from.
HASH_BYTES = 128
KEYS_BUDGET = BROADCAST_BUDGET // 2
# Readers of these versions are not disturbed, and what changed since them can be told.
KEPT_VERSIONS = 4


def measured(keys: DataFrame) -> Lookup:
    """Looked-up keys, broadcast within their own budget."""
    return measured_lookup(keys, KEYS_BUDGET)


def _hash(key: str) -> Column:
    return F.when(F.col(key).isNotNull(), F.xxhash64(key))


def _leading(number: Column) -> Column:
    return F.shiftright(number, SHIFT)


class Conflict(RuntimeError):
    """Another writer committed in the meantime."""


@dataclass(frozen=True)
class DataFile:
    name: str
    rows: int
    first: str | None  # earliest and latest day as text, None without a dated row
    last: str | None
    undated: int

    def may_hold(self, days: set[str | None]) -> bool:
        return None in days and self.undated > 0 or self.first is not None and any(
            day is not None and self.first <= day <= self.last for day in days)


@dataclass(frozen=True)
class IndexFile:
    column: str
    name: str
    rows: int
    least: int
    greatest: int


@dataclass(frozen=True)
class Manifest:
    number: int
    schema: StructType
    data: tuple[DataFile, ...]
    index: tuple[IndexFile, ...]
    sources: Mapping[str, int]  # versions of other tables that this one was made from

    def to_json(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "data": [asdict(f) for f in self.data],
                           "index": [asdict(f) for f in self.index], "sources": dict(self.sources)})

    @classmethod
    def from_json(cls, number: int, text: str) -> Manifest:
        found = json.loads(text)
        return cls(number, StructType.fromJson(found["schema"]),
                   tuple(DataFile(**f) for f in found["data"]),
                   tuple(IndexFile(**f) for f in found["index"]), found["sources"])


@dataclass(frozen=True)
class Replaced:
    rows: int
    files: int  # files of the version before that were rewritten


@dataclass(frozen=True)
class DayTable:
    """The table at ``path``, its rows dated by ``day`` and told apart by ``key``.

    Rows can be looked up by the columns that have an index, ``lookups``. A table with none for
    its key can be replaced as a whole or by days only.
    """

    spark: SparkSession
    path: str
    day: str
    key: str
    lookups: tuple[str, ...] = ()

    # --- reading

    def manifest(self, number: int | None = None) -> Manifest | None:
        """The current version (None before the first commit), or one with a number if it is kept."""
        if number is None:
            names = files.names(self.spark, f"{self.path}/_versions")
            number = max((int(name) for name in names if name.isdigit()), default=0)
        text = files.read_text(self.spark, self._version(number)) if number else None
        return None if text is None else Manifest.from_json(number, text)

    def exists(self) -> bool:
        return self.manifest() is not None

    def read(self, after: str | None = None) -> DataFrame:
        """All rows of the current version, or those of later days than ``after``."""
        manifest = self._current()
        if after is None:
            return self._frame(manifest.schema, manifest.data)
        later = [f for f in manifest.data if f.last is not None and f.last > after]
        return self._frame(manifest.schema, later).filter(F.col(self.day) > F.lit(after).cast("date"))

    def read_days(self, days: set[str | None]) -> DataFrame:
        """Rows of some days, None for those without; other files are not opened."""
        manifest = self._current()
        return self._frame(manifest.schema, [f for f in manifest.data if f.may_hold(days)]) \
            .filter(self._on(days))

    def rows_with(self, column: str, values: DataFrame) -> DataFrame:
        """Rows whose ``column``, which has an index, is one of the values of a one-column frame."""
        manifest = self._current()
        values = values.select(F.col(values.columns[0]).alias(column)).filter(F.col(column).isNotNull())
        bits = values.groupBy(_leading(_hash(column)).alias("bits")).agg(F.count("*").alias("rows")).collect()
        days = self._days_with(manifest, column, values, sum(r["rows"] for r in bits),
                               {r["bits"] for r in bits})
        return self._frame(manifest.schema, [f for f in manifest.data if f.may_hold(days)]) \
            .join(measured(values).side, column, "left_semi").select(*manifest.schema.names)

    def changes(self, since: int) -> DataFrame | None:
        """Rows that this version has and that one had not, and the other way round, with ``change``.

        That is the number of times a row was added (above zero) or removed. Only files that one
        version has and not the other are opened. None if that version is not kept any more.
        """
        old, new = self.manifest(since), self._current()
        if old is None:
            return None
        before = self._frame(old.schema, [f for f in old.data if f not in new.data])
        after = self._frame(new.schema, [f for f in new.data if f not in old.data])
        both = before.withColumn("change", F.lit(-1)).unionByName(after.withColumn("change", F.lit(1)))
        return both.groupBy(*new.schema.names).agg(F.sum("change").alias("change")).filter("change <> 0")

    def frame(self, chosen: Sequence[DataFile]) -> DataFrame:
        """Rows of some files of the current version."""
        return self._frame(self._current().schema, chosen)

    def days(self) -> tuple[str | None, str | None]:
        """First and last day, from the manifest alone."""
        dated = [f for f in self._current().data if f.first is not None]
        return min((f.first for f in dated), default=None), max((f.last for f in dated), default=None)

    def loaded_to(self) -> str | None:
        """High watermark: the last day; None for a missing table, or one without days."""
        return self.days()[1] if self.exists() else None

    # --- committing

    def replace_all(self, frame: DataFrame, sources: Mapping[str, int] = NO_SOURCES) -> None:
        """A version with the rows of ``frame`` alone."""
        base = self.manifest()
        data = self._write_data(frame)
        index = self._write_index(self._frame(frame.schema, data), sum(f.rows for f in data))
        self._commit(Manifest(base.number + 1 if base else 1, frame.schema, data, index, sources))

    def replace_keys(self, delta: DataFrame, gone: DataFrame | None = None,
                     sources: Mapping[str, int] = NO_SOURCES) -> Replaced:
        """A version in which the delta's rows stand for all rows with their keys.

        Rows with a key in the one-column frame ``gone`` are left out too.

        The delta is stored first: it is read several times, and may depend on the table. Of the
        table, only files are opened that may hold one of its keys, or that are small when there
        have come to be many of those. Rows without a key are added.
        """
        base = self._current()
        folder = uuid.uuid4().hex
        delta.select(*base.schema.names).hint("rebalance", self.day).sortWithinPartitions(self.day, self.key) \
            .write.parquet(f"{self.path}/data/{folder}")
        staged = self.spark.read.schema(base.schema).parquet(f"{self.path}/data/{folder}")
        profile = staged.groupBy(_leading(_hash(self.key)).alias("bits")).agg(
            F.count("*").alias("rows"), F.min(self.day).cast("string").alias("first"),
            F.max(self.day).cast("string").alias("last"),
            F.count_if(F.col(self.day).isNull()).alias("undated"), *(
                span for i, column in enumerate(self.lookups) for span in (
                    F.count(column).alias(f"held_{i}"), F.min(_hash(column)).alias(f"least_{i}"),
                    F.max(_hash(column)).alias(f"greatest_{i}")))).collect()  # 2^HASH_BITS + 1 at most
        rows = sum(r["rows"] for r in profile)
        keys, bits, looked_up = staged.select(self.key), {r["bits"] for r in profile}, rows
        if gone is not None:
            keys = keys.unionAll(gone)
            more = gone.select(F.col(gone.columns[0]).alias("key")) \
                .groupBy(_leading(_hash("key")).alias("bits")).agg(F.count("*").alias("rows")).collect()
            bits, looked_up = bits | {r["bits"] for r in more}, rows + sum(r["rows"] for r in more)
        if not looked_up:
            files.delete(self.spark, f"{self.path}/data/{folder}")
            return Replaced(0, 0)
        stale = self._days_with(base, self.key, keys, looked_up, bits - {None})
        rewritten = [f for f in base.data if f.may_hold(stale)]
        if len([f for f in base.data if f.rows < SMALL_ROWS]) > MOST_SMALL_FILES:
            rewritten = [f for f in base.data if f in rewritten or f.rows < SMALL_ROWS]
        written = [n for n in files.names(self.spark, f"{self.path}/data/{folder}") if n.endswith(".parquet")]
        if rows and not rewritten and len(written) == 1:
            dated = [r for r in profile if r["first"] is not None]
            data = (DataFile(f"{folder}/{written[0]}", rows,
                             min((r["first"] for r in dated), default=None),
                             max((r["last"] for r in dated), default=None),
                             sum(r["undated"] for r in profile)),)
        else:
            replaced = measured(keys.filter(F.col(self.key).isNotNull()))
            left = self._frame(base.schema, rewritten).join(replaced.side, self.key, "left_anti") \
                .select(*base.schema.names)
            if not replaced.fits:  # dealing rows to files goes through them twice: join them once
                left = stored(left, "left")
            total = rows + sum(f.rows for f in rewritten)
            data = self._write_data(left.unionByName(staged), few=total <= SMALL_ROWS)
        kept = tuple(f for f in base.data if f not in rewritten)
        # Rows that were only moved to another file keep their day, and so their index rows.
        index = base.index + (self._small_index(staged, profile) if rows <= INDEX_ROWS
                              else self._write_index(staged, rows))
        if len([f for f in index if f.rows < INDEX_ROWS]) > MOST_SMALL_FILES * len(self.lookups):
            index = self._write_index(self._frame(base.schema, kept + data), sum(f.rows for f in kept + data))
        self._commit(Manifest(base.number + 1, base.schema, kept + data, index, sources))
        if not any(f.name.startswith(folder) for f in data):
            files.delete(self.spark, f"{self.path}/data/{folder}")
        return Replaced(rows, len(rewritten))

    def append(self, frame: DataFrame) -> None:
        """A version with further rows, whose keys are known to be new."""
        base = self._current()
        data = self._write_data(frame.select(*base.schema.names))
        index = self._write_index(self._frame(base.schema, data), sum(f.rows for f in data))
        self._commit(Manifest(base.number + 1, base.schema, base.data + data, base.index + index, NO_SOURCES))

    def replace_days(self, frame: DataFrame, days: set[str | None],
                     sources: Mapping[str, int] = NO_SOURCES) -> None:
        """A version in which ``frame`` stands for all rows of some days (None for those without)."""
        base = self._current()
        touched = [f for f in base.data if f.may_hold(days)]
        left = self._frame(base.schema, touched).filter(~self._on(days))
        new = frame.select(*base.schema.names)
        few = sum(f.rows for f in touched) <= SMALL_ROWS and len(days) <= FEW_DAYS
        data = self._write_data(left.unionByName(new), few=few)
        index = self._write_index(new, sum(f.rows for f in data)) if self.lookups else ()
        kept = tuple(f for f in base.data if f not in touched)
        self._commit(Manifest(base.number + 1, base.schema, kept + data, base.index + index, sources))

    def drop_day(self, day: str) -> None:
        """A version without the rows of a day."""
        self.replace_days(self.read().limit(0), {day})

    # --- steps

    def _version(self, number: int) -> str:
        return f"{self.path}/_versions/{number:012d}"

    def _current(self) -> Manifest:
        found = self.manifest()
        if found is None:
            raise FileNotFoundError(f"there is no version of {self.path}")
        return found

    def _frame(self, schema: StructType, chosen: Sequence[DataFile]) -> DataFrame:
        if not chosen:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/data/{f.name}" for f in chosen))

    def _on(self, days: set[str | None]) -> Column:
        """Whether a row is of one of the days; never null."""
        dated = F.col(self.day).cast("string").isin(*sorted(d for d in days if d is not None))
        return F.when(F.col(self.day).isNull(), F.lit(None in days)).otherwise(dated)

    def _write_data(self, frame: DataFrame, few: bool = False) -> tuple[DataFile, ...]:
        """Write rows in order of day and key; ``few`` fit into one file.

        Otherwise ranges of (day, key) are dealt to tasks: small days share a file, and a day
        of any size is split.
        """
        folder = uuid.uuid4().hex
        dealt = frame.coalesce(1) if few else frame.repartitionByRange(self.day, self.key)
        dealt.sortWithinPartitions(self.day, self.key).write.parquet(f"{self.path}/data/{folder}")
        found = self.spark.read.schema(frame.schema).parquet(f"{self.path}/data/{folder}") \
            .groupBy(F.col("_metadata.file_name").alias("name")).agg(
                F.count("*").alias("rows"), F.min(self.day).cast("string").alias("first"),
                F.max(self.day).cast("string").alias("last"),
                F.count_if(F.col(self.day).isNull()).alias("undated")).collect()
        return tuple(DataFile(f"{folder}/{r['name']}", r["rows"], r["first"], r["last"], r["undated"])
                     for r in sorted(found, key=lambda r: (r["first"] or "", r["name"])))

    def _write_index(self, rows: DataFrame, count: int) -> tuple[IndexFile, ...]:
        """Index of ``count`` rows at most for each column that has one; nulls are never looked up."""
        found = []
        for column in self.lookups if count else ():
            folder = uuid.uuid4().hex
            hashes = rows.select(_hash(column).alias("hash"), F.col(self.day).alias("day")) \
                .filter("hash IS NOT NULL")
            parts = -(-count // INDEX_ROWS)
            dealt = hashes.coalesce(1) if parts == 1 else hashes.repartitionByRange(parts, "hash")
            dealt.sortWithinPartitions("hash").write.parquet(f"{self.path}/index/{folder}")
            spans = self.spark.read.schema(INDEX).parquet(f"{self.path}/index/{folder}") \
                .groupBy(F.col("_metadata.file_name").alias("name")).agg(
                    F.count("*").alias("rows"), F.min("hash").alias("least"),
                    F.max("hash").alias("greatest")).collect()
            found += [IndexFile(column, f"{folder}/{r['name']}", r["rows"], r["least"], r["greatest"])
                      for r in sorted(spans, key=lambda r: (r["least"], r["name"]))]
        return tuple(found)

    def _small_index(self, rows: DataFrame, profile: list[Row]) -> tuple[IndexFile, ...]:
        """Index of a delta, one file a column, whose range the delta's profile tells."""
        found = []
        for i, column in enumerate(self.lookups):
            held = [r for r in profile if r[f"held_{i}"]]
            if not held:
                continue
            folder = uuid.uuid4().hex
            rows.select(_hash(column).alias("hash"), F.col(self.day).alias("day")) \
                .filter("hash IS NOT NULL").coalesce(1).sortWithinPartitions("hash") \
                .write.parquet(f"{self.path}/index/{folder}")
            (name,) = (n for n in files.names(self.spark, f"{self.path}/index/{folder}")
                       if n.endswith(".parquet"))
            found.append(IndexFile(column, f"{folder}/{name}", sum(r[f"held_{i}"] for r in held),
                                   min(r[f"least_{i}"] for r in held),
                                   max(r[f"greatest_{i}"] for r in held)))
        return tuple(found)

    def _days_with(self, manifest: Manifest, column: str, values: DataFrame, rows: int,
                   bits: set[int]) -> set[str | None]:
        """Days that may hold a column's values, from the index files in the range of their hashes."""
        if column not in self.lookups:
            raise ValueError(f"{self.path} has no index of {column}")
        chosen = [f for f in manifest.index if f.column == column and any(
            f.least >> SHIFT <= b <= f.greatest >> SHIFT for b in bits)]
        if not chosen:
            return set()
        hashes = values.select(_hash(column).alias("hash")).filter("hash IS NOT NULL")
        side = Lookup(hashes, rows * HASH_BYTES <= BROADCAST_BUDGET).side
        found = self.spark.read.schema(INDEX).parquet(*(f"{self.path}/index/{f.name}" for f in chosen)) \
            .join(side, "hash", "left_semi").select(F.col("day").cast("string")).distinct()
        return {r[0] for r in found.collect()}  # at most the days of the table

    def _commit(self, manifest: Manifest) -> None:
        """Make a version visible. It fails if its number is taken: somebody else was faster."""
        if not files.publish_text(self.spark, self._version(manifest.number), manifest.to_json()):
            raise Conflict(f"version {manifest.number} of {self.path} is by another writer")
        self._forget(manifest)

    def _forget(self, current: Manifest) -> None:
        """Delete the version before the last ones that are kept, and the folders it alone names."""
        number = current.number - KEPT_VERSIONS
        text = files.read_text(self.spark, self._version(number)) if number > 0 else None
        if text is None:
            return
        old = Manifest.from_json(number, text)
        kept = [current, *(Manifest.from_json(n, files.read_text(self.spark, self._version(n)))
                           for n in range(number + 1, current.number))]
        for kind in ("data", "index"):
            named = {f.name.split("/")[0] for manifest in kept for f in getattr(manifest, kind)}
            for folder in {f.name.split("/")[0] for f in getattr(old, kind)} - named:
                files.delete(self.spark, f"{self.path}/{kind}/{folder}")
        files.delete(self.spark, self._version(number))
