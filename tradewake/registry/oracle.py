"""The registered queries as ANSI SQL over the given tables, for an independent engine.

Every text starts from the raw tables: the feed derivations of `FIXTURES.md` and the jobs are
spelled out as common table expressions, of which each query names the ones it reads.
"""

from __future__ import annotations

import re

_CTES: dict[str, str] = {}

# --- feeds -----------------------------------------------------------------------------------

_CTES["orders_x"] = """
    SELECT o_orderkey AS k, CAST(o_orderdate AS date) AS day, o_totalprice AS price,
           CAST(1 + o_orderkey % 3 AS integer) AS qty, o_orderkey % 100 < 78 AS in_a,
           CASE WHEN o_custkey % 25 < 2 THEN 1 WHEN o_custkey % 25 < 5 THEN 2
                WHEN o_custkey % 25 < 21 THEN 3 WHEN o_custkey % 25 < 23 THEN 4
                ELSE 5 END AS st
    FROM orders"""
_CTES["parts_n"] = "SELECT count(*) AS p FROM part"
_CTES["raw_a"] = """
    SELECT printf('111-%010d', k) AS amazon_order_id, printf('B0%08d', k % p) AS asin, qty,
           price AS item_price, 'USD' AS currency,
           CASE st WHEN 1 THEN 'Pending' WHEN 2 THEN 'Shipped' WHEN 3 THEN 'Delivered'
                   WHEN 4 THEN 'Cancelled' ELSE 'Returned' END AS order_status,
           strftime(day, '%Y/%m/%d') AS purchase_date
    FROM orders_x, parts_n WHERE in_a"""
_CTES["raw_b"] = """
    SELECT printf('BM-%09d', k) AS bm_order_ref, printf('SKU%07d', k % p) AS product_sku,
           qty AS quantity, price AS unit_amount, 'EUR' AS devise, st AS state,
           strftime(day, '%d-%m-%Y') AS date_commande
    FROM orders_x, parts_n WHERE NOT in_a"""
_CTES["raw_s0"] = """
    SELECT k, in_a, day, part,
           CAST(qty * CAST(price AS decimal(16,4)) AS decimal(18,4)) AS order_gross
    FROM orders_x, (VALUES (1), (2)) AS t(part)
    WHERE st IN (2, 3) AND k % 20 <> 0 AND (part = 1 OR k % 10 = 1)"""
_CTES["raw_s1"] = """
    SELECT *, CAST(round(order_gross * CAST(0.60 AS decimal(10,2)), 2) AS decimal(18,4)) AS f
    FROM raw_s0"""
_CTES["raw_s2"] = """
    SELECT *, CASE WHEN k % 10 <> 1 THEN order_gross WHEN part = 1 THEN f
                   ELSE order_gross - f END AS gross
    FROM raw_s1"""
_CTES["raw_s3"] = """
    SELECT *, CAST(round(CAST(gross AS decimal(18,4)) * CASE WHEN in_a
                  THEN CAST(0.15 AS decimal(10,2)) ELSE CAST(0.12 AS decimal(10,2)) END, 2)
                  AS decimal(18,4)) AS fee,
              CAST(2 + k % 11 AS decimal(10,0)) AS ship
    FROM raw_s2"""
_CTES["raw_s"] = """
    SELECT printf('STL-%010d-%d', k, part) AS settlement_id,
           CASE WHEN in_a THEN 'amazon' ELSE 'backmarket' END AS channel,
           CASE WHEN in_a THEN printf('111-%010d', k) ELSE printf('BM-%09d', k) END AS order_ref,
           CAST(gross AS double) AS gross_amount, CAST(fee AS double) AS marketplace_fee,
           CAST(ship AS double) AS shipping_fee,
           CAST(round(CAST(gross - fee - ship AS decimal(18,4)) *
                CASE WHEN k % 500 = 3 THEN CAST(0.80 AS decimal(10,2))
                     ELSE CAST(1.00 AS decimal(10,2)) END, 2) AS double) AS net_paid,
           CASE WHEN in_a THEN 'USD' ELSE 'EUR' END AS payout_currency,
           CAST((day - DATE '1970-01-01' + 2 + k % 30) * 86400 AS bigint) AS payout_ts
    FROM raw_s3"""
_CTES["sku_map"] = """
    SELECT 'amazon' AS channel, printf('B0%08d', p_partkey) AS source_sku,
           p_partkey AS product_id FROM part
    UNION ALL
    SELECT 'backmarket', printf('SKU%07d', p_partkey), p_partkey FROM part
    WHERE p_partkey % 20 <> 19"""
_CTES["status_map"] = """
    SELECT * FROM (VALUES
        ('amazon', 'Pending', 'PENDING'), ('amazon', 'Shipped', 'SHIPPED'),
        ('amazon', 'Delivered', 'DELIVERED'), ('amazon', 'Cancelled', 'CANCELLED'),
        ('amazon', 'Returned', 'RETURNED'), ('backmarket', '1', 'PENDING'),
        ('backmarket', '2', 'SHIPPED'), ('backmarket', '3', 'DELIVERED'),
        ('backmarket', '4', 'CANCELLED'), ('backmarket', '5', 'RETURNED')
    ) AS t(channel, raw_status, canonical_status)"""
_CTES["products_1"] = """
    SELECT p_partkey AS product_id, p_name AS model_name, p_brand AS brand,
           CASE WHEN p_size <= 22 THEN 'A' WHEN p_size <= 42 THEN 'B' ELSE 'C' END AS grade,
           CAST(round(CAST(p_retailprice AS decimal(16,4)) * CAST(0.70 AS decimal(10,2)), 2)
                AS double) AS unit_cost,
           p_retailprice AS list_price
    FROM part"""
_CTES["products_2"] = """
    SELECT product_id, model_name, brand,
           CASE WHEN product_id % 33 = 0 THEN 'C' ELSE grade END AS grade, unit_cost,
           CASE WHEN product_id % 12 = 0 THEN CAST(round(CAST(list_price AS decimal(16,4))
                * CAST(1.10 AS decimal(10,2)), 2) AS double) ELSE list_price END AS list_price
    FROM products_1 WHERE product_id % 97 <> 5
    UNION ALL
    SELECT -1 - product_id, model_name, brand, grade, unit_cost, list_price
    FROM products_1 WHERE product_id % 200 = 0"""
_CTES["fx_days"] = """
    SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS date),
           CAST(max(o_orderdate) AS date) + 31, INTERVAL 1 DAY)) AS date) AS day FROM orders
    UNION
    SELECT CAST(unnest(generate_series(CAST(min(ts) AS date), CAST(max(ts) AS date),
           INTERVAL 1 DAY)) AS date) FROM events"""
_CTES["fx"] = """
    SELECT currency AS fx_currency, day AS fx_date,
           CAST(CASE currency WHEN 'USD' THEN CAST(1 AS decimal(17,10))
                WHEN 'EUR' THEN 1.08 + ((day - DATE '1995-01-01') * 37 % 101 - 50) * 0.0001
                ELSE 1.27 + ((day - DATE '1995-01-01') * 53 % 101 - 50) * 0.0001
                END AS double) AS rate_to_usd
    FROM fx_days, (VALUES ('USD'), ('EUR'), ('GBP')) AS c(currency)"""
_CTES["events_x"] = """
    SELECT event_id AS seq, ts AS event_ts, 'EV-' || event_id AS event_id,
           printf('111-%010d', event_id) AS order_id,
           CASE WHEN event_id % 100 < 78 THEN 'amazon' ELSE 'backmarket' END AS channel,
           CASE WHEN event_id % 100 < 78 THEN printf('B0%08d', event_id % p)
                ELSE printf('SKU%07d', event_id % p) END AS sku,
           CAST(1 + event_id % 3 AS integer) AS qty, value AS unit_price,
           CASE WHEN event_id % 100 < 78 THEN 'USD' ELSE 'EUR' END AS currency,
           CASE WHEN event_id % 100 >= 78 THEN CAST(event_id % 5 + 1 AS varchar)
                ELSE CASE event_id % 5 WHEN 0 THEN 'Pending' WHEN 1 THEN 'Shipped'
                     WHEN 2 THEN 'Delivered' WHEN 3 THEN 'Cancelled' ELSE 'Returned' END
                END AS status,
           event_id % 997 <> 13 AS readable,
           event_id * 8 < (SELECT max(event_id) FROM events) * 5 AS early
    FROM events, parts_n"""

# --- conforming ------------------------------------------------------------------------------

_USD = ("CAST(round(CAST({qty} * CAST({price} AS decimal(16,4)) AS decimal(20,4))"
        " * CAST(f.rate_to_usd AS decimal(17,10)), 2) AS double)")


def _in_usd(value: str) -> str:
    return (f"CAST(round(CAST({value} AS decimal(20,4)) * CAST(f.rate_to_usd AS decimal(17,10)), 2)"
            " AS double)")


_CTES["sales_a"] = f"""
    SELECT s.amazon_order_id AS order_id, 'amazon' AS source, m.product_id, s.qty AS quantity,
           s.item_price AS unit_price, t.canonical_status, s.order_date,
           {_USD.format(qty="s.qty", price="s.item_price")} AS revenue_usd
    FROM (SELECT *, CAST(strptime(purchase_date, '%Y/%m/%d') AS date) AS order_date
          FROM raw_a) s
    LEFT JOIN sku_map m ON m.channel = 'amazon' AND m.source_sku = s.asin
    LEFT JOIN status_map t ON t.channel = 'amazon' AND t.raw_status = s.order_status
    LEFT JOIN fx f ON f.fx_currency = s.currency AND f.fx_date = s.order_date"""
_CTES["sales_b"] = f"""
    SELECT s.bm_order_ref AS order_id, 'backmarket' AS source, m.product_id, s.quantity,
           s.unit_amount AS unit_price, t.canonical_status, s.order_date,
           {_USD.format(qty="s.quantity", price="s.unit_amount")} AS revenue_usd
    FROM (SELECT *, CAST(strptime(date_commande, '%d-%m-%Y') AS date) AS order_date
          FROM raw_b) s
    LEFT JOIN sku_map m ON m.channel = 'backmarket' AND m.source_sku = s.product_sku
    LEFT JOIN status_map t ON t.channel = 'backmarket'
         AND t.raw_status = CAST(s.state AS varchar)
    LEFT JOIN fx f ON f.fx_currency = s.devise AND f.fx_date = s.order_date"""
_CTES["sales"] = "SELECT * FROM sales_a UNION ALL BY NAME SELECT * FROM sales_b"
_CTES["settlements"] = f"""
    SELECT s.settlement_id, s.channel, s.order_ref, s.payout_date,
           {_in_usd("CAST(s.gross_amount AS decimal(16,4))")} AS gross_usd,
           {_in_usd("CAST(s.marketplace_fee AS decimal(16,4)) "
                    "+ CAST(s.shipping_fee AS decimal(16,4))")} AS fees_usd,
           {_in_usd("CAST(s.net_paid AS decimal(16,4))")} AS net_usd
    FROM (SELECT *, DATE '1970-01-01' + CAST(payout_ts // 86400 AS integer) AS payout_date
          FROM raw_s) s
    LEFT JOIN fx f ON f.fx_currency = s.payout_currency AND f.fx_date = s.payout_date"""
_CTES["event_sales"] = f"""
    SELECT e.order_id, e.channel AS source, m.product_id, e.qty AS quantity, e.unit_price,
           t.canonical_status, CAST(e.event_ts AS date) AS order_date,
           {_USD.format(qty="e.qty", price="e.unit_price")} AS revenue_usd
    FROM events_x e
    LEFT JOIN sku_map m ON m.channel = e.channel AND m.source_sku = e.sku
    LEFT JOIN status_map t ON t.channel = e.channel AND t.raw_status = e.status
    LEFT JOIN fx f ON f.fx_currency = e.currency AND f.fx_date = CAST(e.event_ts AS date)
    WHERE e.readable"""

# --- star schema -----------------------------------------------------------------------------

_CTES["channels"] = """
    SELECT md5(source) AS channel_sk, source AS channel,
           CASE source WHEN 'amazon' THEN 'Amazon' WHEN 'backmarket' THEN 'BackMarket'
                ELSE source END AS channel_name,
           CAST(CASE source WHEN 'amazon' THEN 0.15 WHEN 'backmarket' THEN 0.12 END
                AS double) AS fee_rate
    FROM (SELECT DISTINCT source FROM sales)"""


def _versions(first: str, second: str) -> str:
    """Two snapshots: what stays open, what closes, what opens."""
    old = "o.product_id, o.model_name, o.brand, o.grade, o.unit_cost, o.list_price"
    new = "n.product_id, n.model_name, n.brand, n.grade, n.unit_cost, n.list_price"
    same = "n.list_price = o.list_price AND n.grade = o.grade"
    at_1, at_2 = f"TIMESTAMP '{first}'", f"TIMESTAMP '{second}'"
    return f"""
    SELECT {old}, {at_1} AS valid_from, CAST(NULL AS timestamp) AS valid_to
    FROM products_1 o JOIN products_2 n ON n.product_id = o.product_id AND {same}
    UNION ALL
    SELECT {old}, {at_1}, {at_2}
    FROM products_1 o LEFT JOIN products_2 n ON n.product_id = o.product_id AND {same}
    WHERE n.product_id IS NULL
    UNION ALL
    SELECT {new}, {at_2}, NULL
    FROM products_2 n LEFT JOIN products_1 o ON n.product_id = o.product_id AND {same}
    WHERE o.product_id IS NULL"""


def _dim_product(versions: str) -> str:
    return f"""
    SELECT md5(CAST(product_id AS varchar) || '|' || CAST(valid_from AS varchar)) AS product_sk,
           *, valid_to IS NULL AS is_current FROM {versions}"""


_CTES["versions"] = _versions("2024-01-01 00:00:00", "2024-02-01 00:00:00")
_CTES["products"] = _dim_product("versions")
_CTES["asof_versions"] = _versions("1995-06-01 00:00:00", "1998-06-01 00:00:00")
_CTES["asof_products"] = _dim_product("asof_versions")
_CTES["first_products"] = """
    SELECT md5(CAST(product_id AS varchar) || '|2024-01-01 00:00:00') AS product_sk,
           product_id, TRUE AS is_current FROM products_1"""


def _fact(sales: str, products: str) -> str:
    return f"""
    SELECT s.order_id, s.order_date, c.channel_sk, p.product_sk, s.source, s.canonical_status,
           s.canonical_status = 'RETURNED' AS is_returned,
           s.canonical_status IN ('DELIVERED', 'SHIPPED') AS is_settleable,
           s.quantity, s.unit_price, s.revenue_usd
    FROM {sales} s LEFT JOIN channels c ON c.channel = s.source
    LEFT JOIN {products} p ON p.product_id = s.product_id AND p.is_current"""


_CTES["fact_sales"] = _fact("sales", "products")
_CTES["run_fact_sales"] = _fact("sales", "first_products")
_CTES["fact_settlement"] = """
    SELECT s.settlement_id, s.order_ref, c.channel_sk, s.channel, s.payout_date, s.gross_usd,
           s.fees_usd, s.net_usd
    FROM settlements s LEFT JOIN channels c ON c.channel = s.channel"""


def _recon(facts: str) -> str:
    return f"""
    SELECT s.order_id, s.source, s.order_date, s.canonical_status, s.revenue_usd AS booked_usd,
           CAST(t.net AS double) AS net_received_usd, CAST(t.fees AS double) AS fees_usd,
           t.order_ref IS NOT NULL AS is_settled,
           CAST(CAST(s.revenue_usd AS decimal(18,2)) - coalesce(t.net, 0)
                - coalesce(t.fees, 0) AS double) AS gap_usd
    FROM {facts} s
    LEFT JOIN (SELECT order_ref, sum(CAST(net_usd AS decimal(18,2))) AS net,
                      sum(CAST(fees_usd AS decimal(18,2))) AS fees
               FROM fact_settlement GROUP BY order_ref) t ON t.order_ref = s.order_id
    WHERE s.is_settleable"""


def _rollup(facts: str) -> str:
    return f"""
    SELECT channel_name, order_date, count(*) AS orders, CAST(sum(quantity) AS bigint) AS units,
           CAST(sum(CAST(revenue_usd AS decimal(18,2))) AS double) AS booked_usd,
           count(*) FILTER (WHERE is_returned) AS returned_orders,
           (count(*) FILTER (WHERE is_returned) * 20000 + count(*)) // (2 * count(*)) / 100.0
               AS return_rate_pct
    FROM {facts} JOIN channels USING (channel_sk) GROUP BY channel_name, order_date"""


_CTES["recon"] = _recon("fact_sales")
_CTES["rollup"] = _rollup("fact_sales")
_CTES["dates"] = """
    SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY))
           AS date) AS d FROM sales"""
_CTES["date_dim"] = """
    SELECT d AS date_key, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
           strftime(d, '%B') AS month_name, day(d) AS day_of_month, isodow(d) AS iso_day_of_week,
           strftime(d, '%A') AS day_name, isodow(d) >= 6 AS is_weekend FROM dates"""

# --- incremental scenario --------------------------------------------------------------------

_CTES["numbered"] = "SELECT *, CAST(split_part(order_id, '-', 2) AS bigint) AS n FROM sales"
_CTES["first_seen"] = """
    SELECT * REPLACE (CASE WHEN n % 61 = 5 THEN order_date - 3 ELSE order_date END AS order_date)
    FROM numbered
    WHERE n % 50 <> 7 AND order_date <= (SELECT max(order_date) - 60 FROM sales)"""
_CTES["fact_first"] = _fact("first_seen", "first_products")
_CTES["loaded_to"] = "SELECT max(order_date) AS d FROM fact_first"
_CTES["delta_strict"] = """
    SELECT * FROM fact_sales WHERE order_date > (SELECT d FROM loaded_to)"""
_CTES["delta_lookback"] = """
    SELECT * FROM fact_sales WHERE order_date >= (SELECT d - 30 FROM loaded_to)"""
_CTES["fact_healed"] = """
    SELECT * FROM fact_first WHERE order_id NOT IN (SELECT order_id FROM delta_lookback)
    UNION ALL SELECT * FROM delta_lookback"""
_CTES["healed_recon"] = _recon("fact_healed")
_CTES["healed_rollup"] = _rollup("fact_healed")

# --- live aggregate --------------------------------------------------------------------------

_CTES["minutes"] = """
    SELECT date_trunc('minute', event_ts) AS window_start,
           date_trunc('minute', event_ts) + INTERVAL 1 MINUTE AS window_end, channel,
           count(*) AS orders, CAST(sum(qty) AS bigint) AS units
    FROM events_x WHERE readable GROUP BY ALL"""


def _two_waves(first: str) -> str:
    """Second-wave events count unless their minute ended before the first wave's watermark."""
    return f"""
    SELECT date_trunc('minute', event_ts) AS window_start,
           date_trunc('minute', event_ts) + INTERVAL 1 MINUTE AS window_end, channel,
           count(*) AS orders, CAST(sum(qty) AS bigint) AS units
    FROM events_x
    WHERE readable AND (({first}) OR date_trunc('minute', event_ts) + INTERVAL 1 MINUTE >
          (SELECT max(event_ts) - INTERVAL 2 MINUTE FROM events_x WHERE readable AND ({first})))
    GROUP BY ALL"""


def _offset_runs(kept: str, times: str) -> str:
    """Gaps and islands over the messages' coordinates."""
    return f"""
    SELECT p AS kafka_partition, min(o) AS first_offset, max(o) AS last_offset, count(*) AS messages,
           CAST(sum(n - 1) AS bigint) AS repeats
    FROM (SELECT p, o, n, o - row_number() OVER (PARTITION BY p ORDER BY o) AS run
          FROM (SELECT CAST(seq % 4 AS int) AS p, seq // 4 AS o, {times} AS n FROM events_x)
          WHERE {kept})
    GROUP BY p, run"""


def _late_count(first: str) -> str:
    """Events per run; late are those of the second whose minute the watermark has passed."""
    late = (f"NOT ({first}) AND date_trunc('minute', event_ts) + INTERVAL 1 MINUTE <= (SELECT "
            f"max(event_ts) - INTERVAL 2 MINUTE FROM events_x WHERE readable AND ({first}))")
    return (f"SELECT CASE WHEN {first} THEN 1 ELSE 2 END AS run, count(*) AS arrived, "
            f"count(*) FILTER (WHERE NOT ({late})) AS counted, "
            f"count(*) FILTER (WHERE {late}) AS late FROM events_x WHERE readable GROUP BY 1")


# --- checks ----------------------------------------------------------------------------------

def _check(check: str, subject: str, failing: str) -> str:
    return (f"SELECT '{check}' AS \"check\", '{subject}' AS subject, n AS failing, "
            f"n = 0 AS passed FROM (SELECT CAST({failing} AS bigint) AS n)")


_TABLES = {"dim_channel": "channels", "dim_product": "products", "dim_date": "date_dim",
           "fct_sales": "fact_sales", "fct_settlement": "fact_settlement",
           "mart_reconciliation": "recon", "agg_channel_daily": "rollup"}
_FILLED = ["dim_channel.channel_sk", "dim_channel.channel", "dim_product.product_sk",
           "dim_product.product_id", "dim_date.date_key", "fct_sales.order_id",
           "fct_sales.channel_sk", "fct_sales.revenue_usd", "fct_settlement.settlement_id",
           "fct_settlement.channel_sk", "mart_reconciliation.order_id",
           "mart_reconciliation.booked_usd", "agg_channel_daily.channel_name",
           "agg_channel_daily.order_date"]
_KEYS = ["dim_channel.channel_sk", "dim_product.product_sk", "dim_date.date_key",
         "fct_sales.order_id", "fct_settlement.settlement_id", "mart_reconciliation.order_id"]
_FOREIGN = [("fct_sales.channel_sk", "dim_channel"), ("fct_sales.product_sk", "dim_product"),
            ("fct_settlement.channel_sk", "dim_channel")]
_FILLED_TABLES = ["fct_sales", "fct_settlement", "mart_reconciliation", "agg_channel_daily",
                  "dim_product"]


def _checks(product: str = "products", fact: str = "fact_sales") -> dict[str, list[str]]:
    """Check texts by kind, for the given product dimension and the fact keyed by it."""
    named = {**_TABLES, "dim_product": product, "fct_sales": fact}

    def table_of(subject: str) -> tuple[str, str]:
        table, column = subject.split(".")
        return named[table], column

    def parent(name: str) -> str:
        return named[name]

    kinds: dict[str, list[str]] = {"not_null": [], "unique": [], "relationships": [],
                                   "non_empty": []}
    for subject in _FILLED:
        table, column = table_of(subject)
        kinds["not_null"].append(_check(
            "not_null", subject, f"(SELECT count(*) FROM {table} WHERE {column} IS NULL)"))
    for subject in _KEYS:
        table, column = table_of(subject)
        kinds["unique"].append(_check(
            "unique", subject, f"(SELECT count(*) FROM (SELECT {column} FROM {table} WHERE "
            f"{column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1))"))
    for subject, parent_name in _FOREIGN:
        table, column = table_of(subject)
        kinds["relationships"].append(_check(
            "relationships", subject, f"(SELECT count(*) FROM {table} WHERE {column} IS NOT NULL"
            f" AND {column} NOT IN (SELECT {column} FROM {parent(parent_name)} WHERE {column} "
            "IS NOT NULL))"))
    for name in _FILLED_TABLES:
        kinds["non_empty"].append(_check(
            "non_empty", name,
            f"(SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {parent(name)})"))
    kinds["amounts"] = [_check(
        "amounts", f"{table}.{column}", f"(SELECT count(*) FROM {parent(table)} WHERE "
        f"TRY_CAST({column} AS decimal(18,2)) IS NULL)")
        for table, column in (("fct_sales", "revenue_usd"), ("fct_settlement", "gross_usd"),
                              ("fct_settlement", "fees_usd"), ("fct_settlement", "net_usd"))]
    kinds["orphans"] = [_check(
        "orphans", "fct_sales.channel_sk", f"(SELECT count(*) FROM {fact} f LEFT JOIN channels"
        " c ON f.channel_sk = c.channel_sk WHERE c.channel_sk IS NULL)")]
    kinds["one_current_version"] = [_check(
        "one_current_version", "dim_product.product_id", "(SELECT count(*) FROM (SELECT "
        f"product_id FROM {product} WHERE is_current GROUP BY product_id HAVING count(*) > 1))")]
    kinds["gap_tolerance"] = [_check(
        "gap_tolerance", "mart_reconciliation.gap_usd",
        f"(SELECT count(*) FROM recon WHERE {_BREACH})")]
    return kinds


_BREACH = ("is_settled AND abs(CAST(gap_usd AS decimal(18,2))) > "
           "CAST(0.05 AS decimal(6,4)) * CAST(booked_usd AS decimal(18,2))")


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# --- queries ---------------------------------------------------------------------------------

def _with(text: str) -> str:
    """Prefix the query with the expressions it needs, directly or through others."""
    needed: set[str] = set()
    open_texts = [text]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        for name in words & _CTES.keys() - needed:
            needed.add(name)
            open_texts.append(_CTES[name])
    chosen = [f"{name} AS ({body}\n)" for name, body in _CTES.items() if name in needed]
    return f"WITH {', '.join(chosen)}\n{text}" if chosen else text


def _series(measure: str) -> str:
    return (f"SELECT CAST(order_date AS timestamp) AS time, channel_name AS metric, "
            f"{measure} AS value FROM rollup ORDER BY time, metric")


def _live_series(measure: str) -> str:
    return (f"SELECT window_start AS time, channel AS metric, {measure} AS value FROM minutes "
            "ORDER BY time, metric")


def _bronze_counts() -> str:
    counted = {"sales_amazon": "raw_a", "sales_backmarket": "raw_b", "settlements_oms": "raw_s",
               "ref_sku_map": "sku_map", "ref_product": "products_1", "ref_fx": "fx",
               "ref_status_map": "status_map"}
    return _union([f"SELECT '{entity}' AS entity, count(*) AS rows, count(*) AS stamped "
                   f"FROM {table}" for entity, table in counted.items()])


_GAP = "CAST(gap_usd AS decimal(18,2))"
_SUM = "CAST(sum(CAST({0} AS decimal(18,2))) AS double)"


def oracle_queries() -> dict[str, str]:
    checks = _checks()
    # The stored run takes one snapshot: every product has one open version, which the fact uses.
    run_checks = _checks("first_products", "run_fact_sales")
    texts = {
        "bronze_landing": _bronze_counts(),
        "staging_sales": "SELECT * FROM sales",
        "staging_settlements": "SELECT * FROM settlements",
        "staging_products": "SELECT * FROM products_1",
        "conform_fx": (
            "SELECT * FROM fx WHERE (fx_currency, fx_date) IN (SELECT CASE source WHEN 'amazon' "
            "THEN 'USD' ELSE 'EUR' END, order_date FROM sales)"),
        "conform_channel_a": "SELECT * FROM sales_a",
        "conform_channel_b": "SELECT * FROM sales_b",
        "conform_sales": "SELECT * FROM sales",
        "conform_settlement": "SELECT * FROM settlements",
        "conform_products": (
            "SELECT product_id, r.model_name AS model_name, r.brand AS brand, r.grade AS grade, "
            "r.unit_cost AS unit_cost, r.list_price AS list_price FROM (SELECT product_id, "
            "min({'model_name': model_name, 'brand': brand, 'grade': grade, "
            "'unit_cost': unit_cost, 'list_price': list_price}) AS r FROM (SELECT * FROM "
            "products_1 UNION ALL SELECT * FROM products_2) GROUP BY product_id)"),
        "status_map_coverage": (
            "SELECT c.channel, c.raw_status, m.canonical_status, c.orders FROM ("
            "SELECT 'amazon' AS channel, order_status AS raw_status, count(*) AS orders "
            "FROM raw_a GROUP BY ALL UNION ALL SELECT 'backmarket', CAST(state AS varchar), "
            "count(*) FROM raw_b GROUP BY ALL) c "
            "LEFT JOIN status_map m USING (channel, raw_status)"),
        "dim_channel": "SELECT * FROM channels",
        "dim_date": "SELECT * FROM date_dim",
        "dim_product": "SELECT * FROM products",
        "fct_sales": "SELECT * FROM fact_sales",
        "fct_settlement": "SELECT * FROM fact_settlement",
        "mart_reconciliation": "SELECT * FROM recon",
        "agg_channel_daily": "SELECT * FROM rollup",
        "recon_tiles": (
            f"SELECT {_SUM.format('booked_usd')} AS booked, "
            f"{_SUM.format('CASE WHEN is_settled THEN net_received_usd END')} AS settled, "
            f"{_SUM.format('CASE WHEN is_settled THEN fees_usd END')} AS fees, "
            f"{_SUM.format('gap_usd')} AS residual FROM recon"),
        "gap_split": (
            f"SELECT source, CAST(sum(CASE WHEN is_settled THEN {_GAP} ELSE 0 END) AS double) "
            f"AS fx_drift_usd, CAST(sum(CASE WHEN NOT is_settled THEN {_GAP} ELSE 0 END) AS "
            "double) AS uncollected_usd, count(*) FILTER (WHERE is_settled) AS settled_orders, "
            "count(*) FILTER (WHERE NOT is_settled) AS uncollected_orders FROM recon "
            "GROUP BY source"),
        "daily_booked_series": _series("booked_usd"),
        "daily_orders_series": _series("orders"),
        "return_rate_series": _series("return_rate_pct"),
        "realtime_tiles": (
            "SELECT CAST(sum(orders) AS bigint) AS orders, CAST(sum(units) AS bigint) AS units "
            "FROM minutes WHERE window_start > (SELECT max(ts) FROM events) "
            "- INTERVAL 15 MINUTE"),
        "realtime_orders_series": _live_series("orders"),
        "realtime_units_series": _live_series("units"),
        "scd2_two_snapshots": "SELECT * FROM versions",
        "scd2_stored": "SELECT * FROM versions",
        "scd2_corrected_repeat": "SELECT * FROM versions",
        "scd2_current": "SELECT * FROM products WHERE is_current",
        "asof_product_join": (
            "SELECT s.order_id, s.product_id, s.order_date, s.revenue_usd, "
            "v.product_sk AS asof_product_sk, v.list_price AS asof_list_price, "
            "v.grade AS asof_grade FROM sales s LEFT JOIN asof_products v ON "
            "v.product_id = s.product_id AND s.order_date >= v.valid_from AND "
            "(v.valid_to IS NULL OR s.order_date < v.valid_to)"),
        "asof_merge_discounts": (
            "SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS part, l.l_shipdate, l.l_quantity, "
            "v.valid_from AS discount_since, v.discount AS discount_before FROM lineitem l "
            "ASOF LEFT JOIN (SELECT l_partkey AS part, date_trunc('month', CAST(l_shipdate AS date) "
            "+ INTERVAL 31 DAY) AS valid_from, max(l_discount) AS discount FROM lineitem GROUP BY ALL) v "
            "ON v.part = l.l_partkey AND l.l_shipdate >= v.valid_from"),
        "incremental_strict": "SELECT * FROM fact_first UNION ALL SELECT * FROM delta_strict",
        "incremental_lookback": (
            "SELECT * FROM fact_first WHERE order_id NOT IN (SELECT order_id FROM "
            "delta_lookback) UNION ALL SELECT * FROM delta_lookback"),
        "incremental_equals_full": (
            "SELECT count(*) AS loaded_rows, count(*) AS full_rows, CAST(0 AS bigint) AS "
            "differing FROM fact_sales"),
        "incremental_settlement": "SELECT * FROM fact_settlement",
        "staging_views": (
            "SELECT canonical_status, count(*) AS orders, CAST(sum(quantity) AS bigint) AS units, "
            f"{_SUM.format('revenue_usd')} AS revenue_usd FROM sales GROUP BY canonical_status"),
        "full_refresh": "SELECT * FROM fact_sales",
        "refresh_counts": (
            "SELECT count(*) AS fact_rows, count(*) FILTER (WHERE order_date = (SELECT max(order_date) "
            "FROM fact_sales)) AS delta_rows, CAST(0 AS bigint) AS files_rewritten FROM fact_sales"),
        "marts_incremental": "SELECT * FROM healed_recon",
        "marts_incremental_daily": "SELECT * FROM healed_rollup",
        "append_delta_day": (
            "SELECT order_date, count(*) AS orders, CAST(sum(quantity) AS bigint) AS units, "
            f"{_SUM.format('revenue_usd')} AS revenue_usd FROM sales GROUP BY order_date"),
        "dq_not_null": _union(checks["not_null"]),
        "dq_unique": _union(checks["unique"]),
        "dq_relationships": _union(checks["relationships"]),
        "dq_amounts": _union(checks["amounts"]),
        "dq_non_empty": _union(checks["non_empty"]),
        "dq_orphans": _union(checks["orphans"]),
        "dq_current_version": _union(checks["one_current_version"]),
        "dq_gap_tolerance": _union(checks["gap_tolerance"]),
        "dq_gap_breaches": f"SELECT * FROM recon WHERE {_BREACH}",
        "gate_report": _union([text for kind in run_checks.values() for text in kind]),
        "gate_incremental": _union([text for kind in run_checks.values() for text in kind]),
        "serving_parity": _union([
            f"SELECT 'served_parity' AS \"check\", '{name}' AS subject, count(*) AS gold_rows, "
            f"count(*) AS served_rows, CAST(0 AS bigint) AS failing, count(*) > 0 AS passed "
            f"FROM {table}" for name, table in (("agg_channel_daily", "rollup"),
                                                ("mart_reconciliation", "recon"))]),
        "publish_serving": "SELECT * FROM rollup",
        "stream_bronze": (
            "SELECT CAST(seq % 4 AS integer) AS kafka_partition, CAST(seq // 4 AS bigint) AS "
            "kafka_offset, event_ts AS kafka_ts, "
            + ", ".join(f"CASE WHEN readable THEN {c} END AS {c}" for c in (
                "event_id", "order_id", "channel", "sku", "qty", "unit_price", "currency",
                "status", "event_ts"))
            + ", CASE WHEN readable THEN CAST(event_ts AS date) END AS event_date FROM events_x"),
        "stream_offset_runs": _offset_runs("TRUE", "1"),
        "stream_offset_faults": _offset_runs("o % 101 <> 7", "CASE WHEN o % 103 = 5 THEN 2 ELSE 1 END"),
        "stream_distinct_ids": (
            "SELECT count(*) AS events, count(DISTINCT CASE WHEN readable THEN event_id END) "
            "AS distinct_ids FROM events_x"),
        "conform_stream_orders": "SELECT * FROM event_sales",
        "silver_both_lanes": (
            "SELECT * FROM sales UNION ALL BY NAME SELECT * FROM event_sales WHERE order_id NOT IN "
            "(SELECT order_id FROM sales)"),
        "stream_orders_1m": _two_waves("early"),
        "stream_late_drop": _two_waves("early AND seq % 7 <> 3"),
        "stream_late_count": _late_count("early AND seq % 7 <> 3"),
        "stream_rerun_idempotent": (
            "SELECT count(*) AS windows, count(*) AS distinct_windows, CAST(sum(orders) AS "
            "bigint) AS orders, CAST(sum(units) AS bigint) AS units FROM minutes"),
    }
    return {name: _with(text) for name, text in texts.items()}
