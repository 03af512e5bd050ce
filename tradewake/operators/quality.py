"""Data-quality checks. Every check yields rows (check, subject, failing, passed)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.functions.money import cents
from tradewake.session import stored

TOLERANCE = 0.05

# Columns that must be filled, must be unique, and must refer to another table.
NOT_NULL: dict[str, tuple[str, ...]] = {
    "dim_channel": ("channel_sk", "channel"),
    "dim_product": ("product_sk", "product_id"),
    "dim_date": ("date_key",),
    "fct_sales": ("order_id", "channel_sk", "revenue_usd"),
    "fct_settlement": ("settlement_id", "channel_sk"),
    "mart_reconciliation": ("order_id", "booked_usd"),
    "agg_channel_daily": ("channel_name", "order_date"),
}
UNIQUE: dict[str, str] = {
    "dim_channel": "channel_sk",
    "dim_product": "product_sk",
    "dim_date": "date_key",
    "fct_sales": "order_id",
    "fct_settlement": "settlement_id",
    "mart_reconciliation": "order_id",
}
REFERENCES: tuple[tuple[str, str, str], ...] = (
    ("fct_sales", "channel_sk", "dim_channel"),
    ("fct_sales", "product_sk", "dim_product"),
    ("fct_settlement", "channel_sk", "dim_channel"),
)
NON_EMPTY = ("fct_sales", "fct_settlement", "mart_reconciliation", "agg_channel_daily",
             "dim_product")
# Amounts that sums are made of: each must be there and be a whole number of cents in range.
AMOUNTS: dict[str, tuple[str, ...]] = {
    "fct_sales": ("revenue_usd",),
    "fct_settlement": ("gross_usd", "fees_usd", "net_usd"),
}

Tables = Mapping[str, DataFrame]


class GateFailure(RuntimeError):
    """The run must not be published."""


def _result(check: str, subject: Column | str, failing: Column, passed: Column) -> list[Column]:
    subject = F.lit(subject) if isinstance(subject, str) else subject
    return [F.lit(check).alias("check"), subject.alias("subject"), failing.alias("failing"),
            passed.alias("passed")]


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def failing(frame: DataFrame, check: str, subject: str) -> DataFrame:
    """Count the given offending rows."""
    counted = frame.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*_result(check, subject, F.col("n"), F.col("n") == 0))


Counter = tuple[str, str, Column]  # check, subject, number of failing rows as an aggregate


def counted(frame: DataFrame, counters: Sequence[Counter]) -> DataFrame:
    """Several checks of one table in one pass over it."""
    names = [f"c{i}" for i in range(len(counters))]
    counts = frame.agg(*[n.cast("long").alias(c) for c, (_, _, n) in zip(names, counters, strict=True)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(subject).alias("subject"), F.col(c).alias("failing"))
        for c, (check, subject, _) in zip(names, counters, strict=True)]))
    return counts.select(rows.alias("r")).select("r.*").withColumn("passed", F.col("failing") == 0)


def null_counters(table: str, columns: Sequence[str]) -> list[Counter]:
    return [("not_null", f"{table}.{c}", F.count_if(F.col(c).isNull())) for c in columns]


def _empty_counter(table: str) -> Counter:
    return "non_empty", table, F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)


def amount_counters(table: str, columns: Sequence[str]) -> list[Counter]:
    return [("amounts", f"{table}.{c}", F.count_if(cents(c).isNull())) for c in columns]


def not_null(tables: Tables, rules: Mapping[str, Sequence[str]] = NOT_NULL) -> DataFrame:
    """All columns of a table in one pass."""
    return stack([counted(tables[t], null_counters(t, columns)) for t, columns in rules.items()])


def amounts(tables: Tables, rules: Mapping[str, Sequence[str]] = AMOUNTS) -> DataFrame:
    """Amounts that are missing or that sums in cents would silently leave out."""
    return stack([counted(tables[t], amount_counters(t, columns)) for t, columns in rules.items()])


def duplicates(frame: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return frame.filter(F.col(key).isNotNull()).groupBy(key) \
        .agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unique(tables: Tables, rules: Mapping[str, str] = UNIQUE) -> DataFrame:
    return stack([failing(duplicates(tables[t], k), "unique", f"{t}.{k}")
                   for t, k in rules.items()])


def key_uses(tables: Tables, child: str,
             rules: Sequence[tuple[str, str, str]] = REFERENCES) -> DataFrame:
    """Rows of a table per combination of its foreign keys, counted in one pass and stored.

    Keys are counted before any join, so one held by a third of the fact arrives as one row.
    """
    columns = [column for table, column, _ in rules if table == child]
    return stored(tables[child].groupBy(*columns).agg(F.count(F.lit(1)).alias("n")), "key-uses")


def lost(uses: DataFrame, column: str, parent: DataFrame, check: str, subject: str) -> DataFrame:
    """Rows whose key has no partner; a NULL key in ``uses`` has none."""
    lost = uses.join(parent.select(column), column, "left_anti") \
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return lost.select(*_result(check, subject, F.col("n"), F.col("n") == 0))


def relationships(tables: Tables, rules: Sequence[tuple[str, str, str]] = REFERENCES,
                  uses: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Non-NULL foreign keys without a partner."""
    if uses is None:
        uses = {child: key_uses(tables, child, rules) for child in {r[0] for r in rules}}
    return stack([
        lost(uses[child].filter(F.col(column).isNotNull()), column, tables[parent],
              "relationships", f"{child}.{column}") for child, column, parent in rules])


def non_empty(tables: Tables, names: Sequence[str] = NON_EMPTY) -> DataFrame:
    """Here ``failing`` is 1 for an empty table."""
    return stack([counted(tables[name], [_empty_counter(name)]) for name in names])


def orphans(tables: Tables, uses: DataFrame | None = None) -> DataFrame:
    """Sales whose channel key resolves to nothing, NULL keys included."""
    if uses is None:
        uses = tables["fct_sales"].groupBy("channel_sk").agg(F.count(F.lit(1)).alias("n"))
    return lost(uses, "channel_sk", tables["dim_channel"], "orphans", "fct_sales.channel_sk")


def one_current_version(tables: Tables) -> DataFrame:
    twice = duplicates(tables["dim_product"].filter("is_current"), "product_id")
    return failing(twice, "one_current_version", "dim_product.product_id")


def _breaks(tolerance: float) -> Column:
    exact = "decimal(18,2)"
    limit = F.lit(str(tolerance)).cast("decimal(6,4)") * F.col("booked_usd").try_cast(exact)
    return F.col("is_settled") & (F.abs(F.col("gap_usd").try_cast(exact)) > limit)


def gap_breaches(recon: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Settled orders whose gap is too large to be currency drift."""
    return recon.filter(_breaks(tolerance))


def gap_tolerance(tables: Tables) -> DataFrame:
    return failing(gap_breaches(tables["mart_reconciliation"]), "gap_tolerance",
                    "mart_reconciliation.gap_usd")


def breach_counter(table: str, tolerance: float = TOLERANCE) -> Counter:
    return "gap_tolerance", f"{table}.gap_usd", F.count_if(F.coalesce(_breaks(tolerance), F.lit(False)))


def full_report(tables: Tables) -> DataFrame:
    """Every check. A table is read once for all counts over its rows, once for each key that
    must be unique, and once for its foreign keys."""
    in_one_pass = []
    for table in dict.fromkeys((*NOT_NULL, *NON_EMPTY, *AMOUNTS)):
        counters = null_counters(table, NOT_NULL.get(table, ()))
        counters += [_empty_counter(table)] if table in NON_EMPTY else []
        counters += amount_counters(table, AMOUNTS.get(table, ()))
        in_one_pass.append(counted(tables[table], counters))
    uses = {child: key_uses(tables, child) for child in {r[0] for r in REFERENCES}}
    return stack([*in_one_pass, unique(tables), relationships(tables, uses=uses),
                   orphans(tables, uses["fct_sales"]), one_current_version(tables),
                   gap_tolerance(tables)])


def served_parity(gold: Tables, served: Mapping[str, DataFrame | None]) -> DataFrame:
    """Every published mart must exist, hold rows, and as many as Gold.

    ``failing`` is the absolute difference in rows; a mart never published has -1 served rows.
    """
    parts = []
    for name, mart in gold.items():
        counted = mart.agg(F.count(F.lit(1)).alias("gold_rows"))
        copy = served.get(name)
        served_rows = F.lit(-1).cast("long") if copy is None else \
            copy.select(F.count(F.lit(1))).scalar()
        rows = counted.withColumn("served_rows", served_rows)
        same = (F.col("served_rows") > 0) & (F.col("served_rows") == F.col("gold_rows"))
        parts.append(rows.select(
            F.lit("served_parity").alias("check"), F.lit(name).alias("subject"),
            "gold_rows", "served_rows",
            F.abs(F.col("gold_rows") - F.col("served_rows")).alias("failing"),
            same.alias("passed")))
    return stack(parts)


def enforce(report: DataFrame) -> None:
    """Raise with every failed check. The report has one row per check, not per data row."""
    failed = report.filter(~F.col("passed")).select("check", "subject", "failing").collect()
    if failed:
        raise GateFailure("; ".join(
            f"{r['check']} {r['subject']}: {r['failing']}" for r in failed))
