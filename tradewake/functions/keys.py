"""Surrogate keys: md5 over the natural key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def channel_key(channel: str) -> Column:
    return F.md5(F.col(channel))


def product_version_key(product_id: str, valid_from: str) -> Column:
    opened = F.coalesce(F.col(valid_from).cast("string"), F.lit("init"))
    return F.md5(F.concat(F.col(product_id).cast("string"), F.lit("|"), opened))
