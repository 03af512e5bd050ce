"""Versioned products (slowly changing dimension, type 2) as one join.

A version row carries the product columns plus ``valid_from`` and ``valid_to`` (NULL while
open). A change of a *tracked* column, or a new product, opens a version at the snapshot time; a
changed or vanished product's open version is closed at that time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewake.operators.lookups import Lookup
from tradewake.schemas import PRODUCT_COLUMNS

TRACKED = ("list_price", "grade")
VERSION_COLUMNS = (*PRODUCT_COLUMNS, "valid_from", "valid_to")
# Days of history of one product that an as-of merge puts into one group.
SPAN_DAYS = 30
# Groups that facts without product or day are spread over.
UNKNOWN = 1024


def first_versions(source: DataFrame, snapshot_ts: Column) -> DataFrame:
    return source.select(*PRODUCT_COLUMNS, snapshot_ts.alias("valid_from"),
                         F.lit(None).cast("timestamp").alias("valid_to"))


def step_versions(open_versions: DataFrame, source: DataFrame, snapshot_ts: Column,
                  tracked: Sequence[str] = TRACKED) -> DataFrame:
    """Open versions and a new source snapshot -> versions open or closed after it.

    Closed history takes no part; the caller keeps it. Re-running the same snapshot changes
    nothing, and a version opened by this very snapshot is corrected in place, so no version
    of zero length appears.
    """
    key = "product_id"
    rest = [c for c in PRODUCT_COLUMNS if c != key]
    old = open_versions.select(
        F.col(key).alias("old_id"),
        F.struct(*rest, "valid_from").alias("old"), F.lit(True).alias("had"))
    new = source.select(
        F.col(key).alias("new_id"), F.struct(*rest).alias("new"), F.lit(True).alias("has"))
    both = old.join(new, F.col("old_id").eqNullSafe(F.col("new_id")), "full_outer")

    had, has = F.col("had").isNotNull(), F.col("has").isNotNull()
    same = reduce(lambda a, b: a & b,
                  [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in tracked])
    keep = had & has & same
    opened_now = F.col("old.valid_from") == snapshot_ts

    def version(id_: str, side: str, start: Column, end: Column) -> Column:
        return F.struct(F.col(id_).alias(key), *[F.col(f"{side}.{c}").alias(c) for c in rest],
                        start.alias("valid_from"), end.alias("valid_to"))

    never = F.lit(None).cast("timestamp")
    kept = F.when(keep, version("old_id", "old", F.col("old.valid_from"), never))
    closed = F.when(had & ~keep & ~opened_now,
                    version("old_id", "old", F.col("old.valid_from"), snapshot_ts))
    opened = F.when(has & ~keep, version("new_id", "new", snapshot_ts, never))
    rows = both.select(F.explode(F.array_compact(F.array(kept, closed, opened))).alias("v"))
    return rows.select("v.*").select(*VERSION_COLUMNS)


def merge_snapshot(versions: DataFrame, source: DataFrame, snapshot_ts: Column,
                   tracked: Sequence[str] = TRACKED) -> DataFrame:
    """Complete version history after one more snapshot."""
    closed = versions.filter("valid_to is not null").select(*VERSION_COLUMNS)
    still_open = versions.filter("valid_to is null")
    return closed.unionByName(step_versions(still_open, source, snapshot_ts, tracked))


def asof_product_join(facts: DataFrame, products: Lookup, day: str = "order_date") -> DataFrame:
    """Give every fact the product version valid on its day (NULL before the first one).

    Equality on the product id carries the join; validity intervals of a product do not
    overlap, so each fact finds at most one version.
    """
    versions = products.map(lambda d: d.select(
        F.col("product_id").alias("version_of"), F.col("product_sk").alias("asof_product_sk"),
        F.col("list_price").alias("asof_list_price"), F.col("grade").alias("asof_grade"),
        "valid_from", "valid_to"))
    at = F.col(day).cast("timestamp")
    valid = ((F.col("product_id") == F.col("version_of")) & (at >= F.col("valid_from"))
             & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))
    return versions.left_join(facts, valid).drop("version_of", "valid_from", "valid_to")


def asof_merge(facts: DataFrame, versions: DataFrame, key: str, day: str,
               span_days: int = SPAN_DAYS) -> DataFrame:
    """Give every fact the ``version`` (a struct) of its key that is valid on its day, or NULL.

    For keys of many versions: an equijoin would pair each fact of a key with all of them. Here facts
    and versions of a key are sorted by time together, and the last version is carried forward.
    Time is cut into spans, so that a hot key's history is many groups; a version is
    in each span it reaches into, which costs a row per span and never one per fact.

    ``versions`` has the key, ``valid_from`` and ``valid_to`` (NULL while open), not overlapping within a key, and
    any other columns. Facts without a key, a day, or a version that early keep NULL.
    """
    # Names of our own, which no column of either side can be.
    when = F.col(day).cast("timestamp")
    span = F.floor(F.unix_seconds(when) / (86400 * span_days))
    unknown = F.col(key).isNull() | when.isNull()
    whole = F.struct(*facts.columns)
    spread = F.pmod(F.xxhash64(*facts.columns), F.lit(UNKNOWN))
    sold = facts.select(
        F.when(~unknown, F.col(key)).alias("k"), F.when(unknown, spread).otherwise(span).alias("part"),
        F.when(~unknown, when).alias("at"), F.lit(1).alias("kind"), whole.alias("fact"))
    ends = facts.agg(F.min(when).alias("first"), F.max(when).alias("last")).head()
    if ends["first"] is None:
        return facts.withColumn("version", F.lit(None).cast(versions.schema))
    first, last = F.lit(ends["first"]), F.lit(ends["last"])

    def span_of(moment: Column) -> Column:
        return F.floor(F.unix_seconds(moment) / (86400 * span_days))

    begin, end = F.col("valid_from"), F.coalesce(F.col("valid_to"), last)
    known = versions.filter(F.col(key).isNotNull() & (begin <= last) & (end >= first))
    reached = F.sequence(span_of(F.greatest(begin, first)), span_of(F.least(end, last)))
    offered = known.select(
        F.col(key).alias("k"), F.explode(reached).alias("part"), begin.alias("at"), F.lit(0).alias("kind"),
        F.struct(*versions.columns).alias("offer"))
    both = sold.unionByName(offered, allowMissingColumns=True)
    so_far = Window.partitionBy("k", "part").orderBy("at", "kind") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.last("offer", ignorenulls=True).over(so_far)
    found = both.withColumn("carried", carried).filter("kind = 1")
    holds = F.col("at").isNotNull() & (F.col("carried.valid_to").isNull() | (F.col("at") < F.col("carried.valid_to")))
    return found.select("fact.*", F.when(holds, F.col("carried")).alias("version"))
