"""The gate over versioned tables, at the cost of what changed since it last ran.

Data files never change, so what a check counts in a file is counted once: a profile beside the lake
has the counts and the used foreign keys of every file, and a gate reads files that are
new to it. Dimensions may change under old facts; used keys are compared with them anew
each time. A key that was unique in an earlier version is looked for among the keys that changed since,
by the table's index. The report is that of ``quality.full_report``.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.operators import quality
from tradewake.session import stored, together
from tradewake.sources import files
from tradewake.sources.day_table import DataFile
from tradewake.sources.lake import DAY_TABLES, Lake

VERSIONED = tuple(name for zone, name in DAY_TABLES if zone == "gold")


def counters(table: str) -> list[quality.Counter]:
    """Failing rows that add up over files."""
    found = quality.null_counters(table, quality.NOT_NULL.get(table, ()))
    found += quality.amount_counters(table, quality.AMOUNTS.get(table, ()))
    return found + ([quality.breach_counter(table)] if table == "mart_reconciliation" else [])


def foreign_keys(table: str) -> list[str]:
    return [column for child, column, _ in quality.REFERENCES if child == table]


class Profile:
    """Counts and used keys of a table's files, kept under the rules they were made by."""

    def __init__(self, lake: Lake, name: str):
        self.table, self.name = lake.day_table("gold", name), name
        self.counters, self.keys = counters(name), foreign_keys(name)
        self.names = [f"c{i}" for i in range(len(self.counters))]
        rules = json.dumps([[check, subject] for check, subject, _ in self.counters] + [self.keys])
        self.path = f"{lake.root}/gate/{name}-{hashlib.sha256(rules.encode()).hexdigest()[:12]}"
        self.spark = lake.spark

    def _kept(self, part: str, of: list[DataFile]) -> DataFrame | None:
        """Stored rows about some files; a file profiled twice counts once."""
        if not files.has_data(self.spark, f"{self.path}/{part}"):
            return None
        named = self.spark.createDataFrame([(f.name,) for f in of], "file string")
        kept = self.spark.read.parquet(f"{self.path}/{part}") \
            .join(F.broadcast(named), "file", "left_semi")  # as large as the manifest
        if part == "counts":
            return kept.dropDuplicates(["file"])
        # Uses are about as many as rows: they are shuffled to drop repeated ones only if there are any.
        rows = {r["file"]: r["n"] for r in kept.groupBy("file").agg(F.sum("n").alias("n")).collect()}
        once = all(rows.get(f.name, 0) == f.rows for f in of)
        return kept if once else kept.dropDuplicates(["file", *self.keys])

    def update(self) -> int:
        """Profile the files that have none yet; returns how many."""
        manifest = self.table.manifest()
        kept = self._kept("counts", list(manifest.data))
        known = {r["file"] for r in kept.select("file").collect()} if kept is not None else set()
        new = [f for f in manifest.data if f.name not in known]
        if new:
            rows = self.table.frame(new).withColumn(
                "file", F.substring_index(F.col("_metadata.file_path"), "/", -2))
            if self.keys:
                rows.groupBy("file", *self.keys).agg(F.count("*").alias("n")) \
                    .write.mode("append").parquet(f"{self.path}/uses")
            # Written last: a file without counts is profiled again.
            rows.groupBy("file").agg(F.count("*").alias("rows"), *(
                count.cast("long").alias(n) for n, (_, _, count) in zip(self.names, self.counters, strict=True))) \
                .write.mode("append").parquet(f"{self.path}/counts")
        return len(new)

    def counts(self) -> DataFrame:
        """The additive checks and, where it is one, that the table is not empty."""
        checks = [("non_empty", self.name)] if self.name in quality.NON_EMPTY else []
        checks += [(check, subject) for check, subject, _ in self.counters]
        kept = self._kept("counts", list(self.table.manifest().data))
        totals = {} if kept is None else kept.agg(
            *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", *self.names))).head().asDict()
        failing = [int(not totals.get("rows"))] if self.name in quality.NON_EMPTY else []
        failing += [totals.get(c, 0) for c in self.names]
        return self.spark.createDataFrame(
            [(check, subject, n, n == 0) for (check, subject), n in zip(checks, failing, strict=True)],
            "check string, subject string, failing bigint, passed boolean")

    def uses(self) -> DataFrame:
        """Rows per combination of foreign keys."""
        kept = self._kept("uses", list(self.table.manifest().data))
        if kept is None:
            empty = self.table.read().limit(0).groupBy(*self.keys).agg(F.count("*").alias("n"))
            return stored(empty, "key-uses")
        return stored(kept.groupBy(*self.keys).agg(F.sum("n").alias("n")), "key-uses")

    def repeated(self) -> DataFrame:
        """Keys that occur more than once: of all, or of those that changed since a version without any."""
        key, number = quality.UNIQUE[self.name], self.table.manifest().number
        verified = files.read_text(self.spark, f"{self.path}/unique")
        changed = self.table.changes(int(verified)) if verified else None
        if changed is None:
            rows = self.table.read().select(key)
        else:
            added = stored(changed.filter("change > 0").select(key).distinct(), "added-keys")
            rows = self.table.rows_with(key, added)
        found = stored(quality.duplicates(rows, key), "repeated-keys")
        if found.isEmpty():
            files.write_text(self.spark, f"{self.path}/unique", str(number))
        return quality.failing(found, "unique", f"{self.name}.{key}")


def report(lake: Lake) -> DataFrame:
    """Every check of ``quality.full_report``, of large tables by their files' profiles."""
    profiles = {name: Profile(lake, name) for name in VERSIONED}
    together(lake.spark, *(profile.update for profile in profiles.values()))
    small = {name: lake.read("gold", name) for name in quality.NOT_NULL if name not in profiles}
    keyed = [name for name, p in profiles.items() if p.keys]
    found = together(lake.spark, *(profiles[name].uses for name in keyed),
                     *(p.counts for p in profiles.values()),
                     *(p.repeated for name, p in profiles.items() if name in quality.UNIQUE))
    uses, parts = dict(zip(keyed, found, strict=False)), found[len(keyed):]
    parts += [quality.not_null(small, {t: c for t, c in quality.NOT_NULL.items() if t in small}),
              quality.non_empty(small, [t for t in quality.NON_EMPTY if t in small]),
              quality.unique(small, {t: k for t, k in quality.UNIQUE.items() if t in small}),
              quality.relationships(small, uses=uses), quality.orphans(small, uses["fct_sales"]),
              quality.one_current_version(small)]
    return quality.stack(parts)
