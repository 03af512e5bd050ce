"""Left joins against lookup tables, broadcast only after their size was measured.

Mapping tables, exchange rates and dimensions are usually tiny next to the fact, and a broadcast
join then spares the fact a shuffle, whatever its key skew. But they grow too. So a lookup is
measured first (rows and bytes, one small aggregation for all lookups of a job) and broadcast
only within a budget. Beyond it the join is shuffled, and adaptive execution splits the
partitions that a hot key overloads.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

BROADCAST_BUDGET = 64 * 1024 * 1024
_ROW_OVERHEAD = 32
_FIELD_WIDTH = 16


@dataclass(frozen=True)
class Lookup:
    frame: DataFrame
    fits: bool

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Lookup:
        """Narrow the lookup (filter, project, rename). It never gets larger, so ``fits`` holds."""
        return replace(self, frame=change(self.frame))

    @property
    def side(self) -> DataFrame:
        """The frame as the right side of an equijoin: broadcast if it fits, and otherwise not at all.

        Spark's own estimate starts from the bytes of compressed files, and would send some
        frames to the driver that take many times the budget there.
        """
        return F.broadcast(self.frame) if self.fits else self.frame.hint("merge")

    def left_join(self, fact: DataFrame, on: str | list[str] | Column) -> DataFrame:
        return fact.join(self.side, on, "left")

    def inner_join(self, fact: DataFrame, on: str | list[str] | Column) -> DataFrame:
        return fact.join(self.side, on, "inner")


def _size(name: str, frame: DataFrame) -> DataFrame:
    """One row (name, bytes): an upper estimate of the frame in Spark's row format."""
    variable = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
                for f in frame.schema.fields if isinstance(f.dataType, StringType | BinaryType)]
    fixed = _ROW_OVERHEAD + _FIELD_WIDTH * len(frame.columns)
    per_row = reduce(lambda a, b: a + b, variable, F.lit(fixed).cast("long"))
    return frame.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("bytes")) \
        .select(F.lit(name).alias("name"), "bytes")


def measure(frames: Mapping[str, DataFrame],
            budget: int = BROADCAST_BUDGET) -> dict[str, Lookup]:
    """Measure all frames in one job. The driver gets one number per frame."""
    sizes = reduce(DataFrame.unionAll, [_size(n, f) for n, f in frames.items()])
    measured = {row["name"]: row["bytes"] for row in sizes.collect()}
    return {n: Lookup(f, measured[n] <= budget) for n, f in frames.items()}


def measured(frame: DataFrame, budget: int = BROADCAST_BUDGET) -> Lookup:
    return measure({"lookup": frame}, budget)["lookup"]
