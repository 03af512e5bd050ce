"""Money arithmetic in decimals.

Feeds deliver amounts as doubles. Every amount is turned into a decimal *before* any
arithmetic, so that products, differences and sums are exact and do not depend on the order in
which executors add them up; only the final value goes back to double. The precisions are
chosen so that quantity x price x rate stays within decimal(38), hence loses no digit before
the one rounding to cents.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(16,4)"
GROSS = "decimal(20,4)"
RATE = "decimal(17,10)"
CENTS = "decimal(18,2)"


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def amount(value: str | Column) -> Column:
    """A feed amount as decimal; NULL (for the gate to find) if it is out of range."""
    return _column(value).try_cast(AMOUNT)


def cents(value: str | Column) -> Column:
    """An amount that already is a whole number of cents, as decimal."""
    return _column(value).try_cast(CENTS)


def gross(quantity: str | Column, price: str | Column) -> Column:
    return (_column(quantity) * amount(price)).try_cast(GROSS)


def to_usd(value: Column, rate: str | Column) -> Column:
    """Decimal amount times the day's rate, in cents, as double. No rate gives NULL."""
    return F.round(value * _column(rate).try_cast(RATE), 2).cast("double")


def share_pct(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, two decimals; NULL for an empty whole."""
    ratio = part.cast("decimal(18,0)") * 100 / F.nullif(whole.cast("decimal(18,0)"), F.lit(0))
    return F.round(ratio, 2).cast("double")
