"""Every query of the library against its SQL, complete results.

The tables are the smallest given ones, as they are. `tests/compare.py` does the same on any of the
given folders.
"""

from __future__ import annotations

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from tradewake.registry.oracle import oracle_queries
from tradewake.registry.queries import registered

GIVEN = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(registered()) == set(oracle_queries())
    assert set(oracle_sql()) <= set(queries()) and set(registered()) <= set(queries())


def test_entry_is_the_rollup(spark):
    frame = entry(spark)
    assert frame.columns == ["channel_name", "order_date", "orders", "units", "booked_usd",
                             "returned_orders", "return_rate_pct"]
    assert frame.count() > 0


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_matches_sql(spark, name):
    result = queries()[name](spark, GIVEN).toPandas()
    assert differences(result, connect(GIVEN).execute(oracle_sql()[name]).df()) == ""
