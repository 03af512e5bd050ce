"""Time an incremental refresh of the sales fact against a full rebuild."""

from __future__ import annotations

import time
from dataclasses import asdict, dataclass

from pyspark.sql import functions as F

from tradewake.plans.daily_run import refresh_fct_sales
from tradewake.sources.lake import Lake


@dataclass(frozen=True)
class Timing:
    fact_rows: int
    delta_rows: int
    files_rewritten: int
    incremental_sec: float
    full_sec: float

    def as_dict(self) -> dict:
        return asdict(self)


def hold_back_last_day(lake: Lake) -> str | None:
    """Take the last day out of the sales fact, as if Silver had just got it."""
    table = lake.day_table("gold", "fct_sales")
    day = table.loaded_to()
    if day is not None:
        table.drop_day(day)
    return day


def time_refresh(lake: Lake) -> Timing:
    """Needs a finished daily run. Loads its last day anew, then rebuilds the fact."""
    hold_back_last_day(lake)
    start = time.perf_counter()
    replaced = refresh_fct_sales(lake)
    middle = time.perf_counter()
    refresh_fct_sales(lake, full_refresh=True)
    end = time.perf_counter()
    rows = lake.read("gold", "fct_sales").agg(F.count(F.lit(1))).first()[0]
    return Timing(rows, replaced.rows, replaced.files,
                  round(middle - start, 3), round(end - middle, 3))
