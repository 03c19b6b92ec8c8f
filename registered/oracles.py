"""The SQL that each registered query is checked against, over the same sample tables.

Written as plain joins and windows, apart from the way the engine computes the same sets.
"""

from __future__ import annotations

_TX = "TIMESTAMP '2024-01-21 06:00:00'"
_TY = "TIMESTAMP '2024-02-01 06:00:00'"
_CREATED = "TIMESTAMP '2024-01-01 00:00:00'"

# Every feed as (kind, product_id, day, units).
_DENSE_FEED = """
  SELECT CASE event_type WHEN 'signup' THEN 'in' WHEN 'purchase' THEN 'out' WHEN 'error' THEN 'adj' ELSE 'log' END AS kind,
         CAST(user_id AS INTEGER) AS product_id, CAST(ts AS DATE) AS day,
         CASE event_type WHEN 'error' THEN event_id % 7 - 3
              WHEN 'view' THEN CAST(floor(value) AS BIGINT) + 40
              WHEN 'click' THEN CAST(floor(value) AS BIGINT) + 40
              ELSE CAST(floor(value) AS BIGINT) END AS units
  FROM events WHERE event_type IN ('view', 'click', 'signup', 'purchase', 'error')"""

_WIDE_FEED = """
  SELECT 'log' AS kind, CAST(l_partkey AS INTEGER) AS product_id, CAST(l_shipdate AS DATE) AS day,
         CAST(l_quantity AS BIGINT) + 40 AS units FROM lineitem
  UNION ALL
  SELECT CASE WHEN l_linestatus = 'F' THEN 'in' WHEN l_returnflag = 'R' THEN 'adj' ELSE 'out' END,
         CAST(l_partkey AS INTEGER), CAST(l_shipdate AS DATE),
         CASE WHEN l_linestatus <> 'F' AND l_returnflag = 'R' THEN -1 - CAST(l_quantity AS BIGINT) % 3
              ELSE CAST(l_quantity AS BIGINT) END
  FROM lineitem WHERE l_linestatus IN ('F', 'O')"""


def _chain(feed: str, tag: str = "", since: str | None = None, lead: int = 5, safety: int = 3) -> str:
    """CTEs feed, totals, ledger, rolled, measured and advised (each with a tag appended).

    Adding 0 to a rounded ratio turns a negative zero into zero; the two are equal, but not bit by bit.
    """
    clip = f" WHERE day >= DATE '{since}'" if since else ""
    return f"""
feed{tag} AS (SELECT * FROM ({feed}) AS f{clip}),
totals{tag} AS (
  SELECT kind, day, product_id, CAST(sum(units) AS BIGINT) AS units FROM feed{tag} GROUP BY kind, day, product_id),
logged{tag} AS MATERIALIZED (SELECT day, product_id, units FROM totals{tag} WHERE kind = 'log'),
prior{tag} AS MATERIALIZED (SELECT CAST(day + 1 AS DATE) AS day, product_id, units FROM totals{tag} WHERE kind = 'log'),
got{tag} AS MATERIALIZED (SELECT day, product_id, units FROM totals{tag} WHERE kind = 'in'),
sold{tag} AS MATERIALIZED (SELECT day, product_id, units FROM totals{tag} WHERE kind = 'out'),
fixed{tag} AS MATERIALIZED (SELECT day, product_id, units FROM totals{tag} WHERE kind = 'adj'),
figures{tag} AS (
  SELECT log.day AS inventory_date, log.product_id, coalesce(prior.units, 0) AS stock_awal,
         coalesce(got.units, 0) AS quantity_received, coalesce(sold.units, 0) AS quantity_sold,
         coalesce(fix.units, 0) AS quantity_adjusted, log.units AS stock_aktual_system
  FROM logged{tag} AS log
  LEFT JOIN prior{tag} AS prior ON prior.product_id = log.product_id AND prior.day = log.day
  LEFT JOIN got{tag} AS got ON got.product_id = log.product_id AND got.day = log.day
  LEFT JOIN sold{tag} AS sold ON sold.product_id = log.product_id AND sold.day = log.day
  LEFT JOIN fixed{tag} AS fix ON fix.product_id = log.product_id AND fix.day = log.day),
ledger{tag} AS (
  SELECT inventory_date, product_id, stock_awal, quantity_received, quantity_sold, quantity_adjusted,
         stock_awal + quantity_received - quantity_sold + quantity_adjusted AS stock_akhir, stock_aktual_system,
         stock_aktual_system - stock_awal - quantity_received + quantity_sold - quantity_adjusted AS selisih
  FROM figures{tag}),
rolled{tag} AS (
  SELECT *, round(avg(quantity_sold) OVER seven, 2) AS daily_sales_velocity,
         avg(stock_akhir) OVER thirty AS avg_stock_30d,
         CAST(sum(quantity_sold) OVER thirty AS BIGINT) AS total_sales_30d
  FROM ledger{tag}
  WINDOW seven AS (PARTITION BY product_id ORDER BY inventory_date ROWS 6 PRECEDING),
         thirty AS (PARTITION BY product_id ORDER BY inventory_date ROWS 29 PRECEDING)),
ratios{tag} AS (
  SELECT *, CASE WHEN daily_sales_velocity <> 0 THEN CAST(stock_akhir AS DOUBLE) / daily_sales_velocity END AS days_left,
         CASE WHEN avg_stock_30d <> 0 THEN CAST(total_sales_30d AS DOUBLE) / avg_stock_30d END AS turns
  FROM rolled{tag}),
measured{tag} AS (
  SELECT * EXCLUDE (avg_stock_30d, total_sales_30d, days_left, turns),
         coalesce(round(days_left, 2) + 0, CAST(999 AS DOUBLE)) AS days_of_inventory,
         coalesce(round(turns, 2) + 0, CAST(0 AS DOUBLE)) AS inventory_turnover_rate,
         CASE WHEN days_left < 15 THEN 'FAST_MOVING' WHEN days_left <= 60 THEN 'SLOW_MOVING'
              ELSE 'STAGNANT' END AS sales_speed_class
  FROM ratios{tag}),
levels{tag} AS (
  SELECT *, round(daily_sales_velocity * {safety}) AS safety_stock,
         round(daily_sales_velocity * {lead} + daily_sales_velocity * {safety}) AS reorder_point
  FROM measured{tag}),
advised{tag} AS (
  SELECT * EXCLUDE (safety_stock, reorder_point), stock_akhir < reorder_point AS reorder_alert,
         CAST(CASE WHEN stock_akhir < reorder_point THEN reorder_point - stock_akhir + safety_stock ELSE 0 END
              AS INTEGER) AS recommended_reorder_qty
  FROM levels{tag})"""


_DENSE = _chain(_DENSE_FEED)
_WIDE = _chain(_WIDE_FEED)


def _daily_rows(source: str, stamp: str) -> str:
    """A daily mart in the shape of its fact."""
    counts = ", ".join(
        f"CAST({c} AS INTEGER) AS {c}"
        for c in (
            "stock_awal",
            "quantity_received",
            "quantity_sold",
            "quantity_adjusted",
            "stock_akhir",
            "stock_aktual_system",
            "selisih",
        )
    )
    rates = ", ".join(
        f"CAST({c} AS DECIMAL(10,2)) AS {c}"
        for c in ("daily_sales_velocity", "days_of_inventory", "inventory_turnover_rate")
    )
    return (
        "SELECT CAST(date_diff('day', DATE '1970-01-01', inventory_date) AS BIGINT) * 4294967296 + product_id AS id,"
        f" inventory_date, product_id, {counts}, {rates}, sales_speed_class, reorder_alert,"
        f" recommended_reorder_qty, {stamp} AS ingestion_date FROM {source}"
    )


_CENTS = "CAST(CAST({0} AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2))"
_PRICE = _CENTS.format("event_id % 9000 + 500")
_DISCOUNT = f"CASE WHEN event_id % 4 = 0 THEN {_CENTS.format('50')} ELSE {_CENTS.format('0')} END"
_UNITS = "CAST(floor(value) AS INTEGER)"

_MOVED = f"""
moved AS (
  SELECT CAST(ts AS DATE) AS movement_date, CAST(user_id AS INTEGER) AS product_id,
         CASE event_type WHEN 'signup' THEN CAST(user_id % 5 + 1 AS INTEGER) END AS supplier_id,
         CASE event_type WHEN 'signup' THEN 'INBOUND' WHEN 'purchase' THEN 'OUTBOUND' ELSE 'ADJUSTMENT' END AS movement_type,
         CASE event_type WHEN 'error' THEN CAST(event_id % 7 - 3 AS INTEGER) ELSE {_UNITS} END AS quantity,
         CASE WHEN event_type <> 'error' THEN {_PRICE} END AS unit_price,
         CAST(CASE event_type WHEN 'signup' THEN {_UNITS} * {_PRICE}
              WHEN 'purchase' THEN {_UNITS} * ({_PRICE} - {_DISCOUNT}) END AS DECIMAL(12,2)) AS total_amount,
         event_id AS source_reference_id
  FROM events WHERE event_type IN ('signup', 'purchase', 'error'))"""

_PRODUCTS = f"""
products AS (
  SELECT CAST(p_partkey AS INTEGER) AS product_id, 'PRD-' || p_partkey AS code, p_name AS name, p_type AS category,
         p_brand AS barcode, CAST(p_size AS DECIMAL(10,2)) AS weight, p_partkey % 10 <> 0 AS is_active,
         {_CREATED} AS created_at
  FROM part)"""

_CHANGED = f"""{_PRODUCTS},
changed AS (
  SELECT product_id, code, name, barcode,
         CASE WHEN product_id % 11 = 0 THEN category || ' II' ELSE category END AS category,
         CASE WHEN product_id % 7 = 0 THEN weight + 1 WHEN product_id % 17 <> 0 THEN weight END AS weight,
         CASE WHEN product_id % 19 = 0 THEN NOT is_active ELSE is_active END AS is_active
  FROM products WHERE product_id % 13 <> 0
  UNION ALL
  SELECT product_id + 1000000, 'PRD-' || (product_id + 1000000), name, barcode, category, weight, is_active
  FROM products WHERE product_id % 20 = 0),
first_load AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_sk, * FROM products),
compared AS (
  SELECT c.*, o.product_sk AS old_sk,
         CASE WHEN o.product_sk IS NULL THEN 'insert'
              WHEN c.name IS DISTINCT FROM o.name OR c.category IS DISTINCT FROM o.category
                OR c.barcode IS DISTINCT FROM o.barcode OR c.is_active IS DISTINCT FROM o.is_active
                OR (c.weight IS NULL AND o.weight IS NOT NULL) OR abs(c.weight - o.weight) > 0.001 THEN 'change'
              ELSE 'keep' END AS action
  FROM changed AS c LEFT JOIN first_load AS o USING (product_id))"""

_SUPPLIERS = f"""
suppliers AS (
  SELECT CAST(s_suppkey AS INTEGER) AS supplier_id, 'SUP-' || s_suppkey AS code, s_name AS name,
         CASE WHEN s_suppkey % 5 <> 0 THEN 's' || s_suppkey || '@example.com' END AS email, n_name AS country,
         {_CREATED} AS created_at
  FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey)"""

_STATE = """
state AS (
  SELECT 'user-' || user_id AS pipeline_name, user_id, max(CAST(ts AS DATE)) AS last_success_date, max(ts) AS updated_at
  FROM events GROUP BY user_id)"""

_RUNS = """
runs AS (
  SELECT o_orderkey AS run_id, o_orderpriority AS pipeline_name,
         CASE o_orderstatus WHEN 'O' THEN 'RUNNING' WHEN 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS run_status,
         o_orderdate AS start_time,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 1 HOUR END AS end_time,
         CAST(0 AS BIGINT) AS records_extracted,
         CASE WHEN o_orderstatus = 'F' THEN (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) ELSE 0 END
           AS records_loaded,
         CAST(0 AS INTEGER) AS dq_checks_passed, CAST(0 AS INTEGER) AS dq_checks_failed,
         CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'order is partial' END AS error_message
  FROM orders)"""


def _per_day(kind: str, total: str) -> str:
    return (
        f"WITH feed AS ({_DENSE_FEED}) SELECT day AS inventory_date, product_id, CAST(sum(units) AS BIGINT) AS {total}"
        f" FROM feed WHERE kind = '{kind}' GROUP BY day, product_id"
    )


ORACLES: dict[str, str] = {
    "scan_products": f"WITH {_PRODUCTS} SELECT * FROM products",
    "scan_suppliers": f"WITH {_SUPPLIERS} SELECT * FROM suppliers",
    "incremental_sales": f"""
        SELECT event_id AS transaction_id, 'TX-' || event_id AS transaction_number, ts AS transaction_date,
               CAST(user_id AS INTEGER) AS product_id, {_UNITS} AS quantity, {_PRICE} AS unit_price,
               CAST({_DISCOUNT} AS DECIMAL(5,2)) AS discount,
               CAST({_UNITS} * ({_PRICE} - {_DISCOUNT}) AS DECIMAL(12,2)) AS total_amount, ts AS created_at
        FROM events WHERE event_type = 'purchase' AND ts >= DATE '2024-01-15'""",
    "incremental_purchases": f"""
        SELECT l_orderkey * 8 + l_linenumber AS po_detail_id, l_orderkey AS po_header_id, 'PO-' || o_orderkey AS po_number,
               CAST(o_custkey % 100 AS INTEGER) AS supplier_id, CAST(o_orderdate AS DATE) AS order_date,
               CAST(l_partkey AS INTEGER) AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
               {_CENTS.format("floor(l_extendedprice)")} AS unit_price, CAST(l_quantity AS INTEGER) AS received_quantity,
               l_shipdate AS received_date
        FROM lineitem INNER JOIN orders ON o_orderkey = l_orderkey
        WHERE l_linestatus = 'F' AND l_shipdate >= DATE '1998-06-01'""",
    "incremental_adjustments": """
        SELECT event_id AS adjustment_id, 'ADJ-' || event_id AS adjustment_number, ts AS adjustment_date,
               CAST(user_id AS INTEGER) AS product_id, CAST(event_id % 7 - 3 AS INTEGER) AS quantity,
               'count' AS reason, ts AS created_at
        FROM events WHERE event_type = 'error' AND ts >= DATE '2024-01-15'""",
    "incremental_stock_daily": f"""
        SELECT CAST(user_id AS INTEGER) AS product_id, event_type AS location_code, {_UNITS} + 40 AS onhand_quantity,
               ts AS created_date
        FROM events WHERE event_type IN ('view', 'click') AND ts >= DATE '2024-01-15'""",
    "date_product_spine": """
        SELECT CAST(ts AS DATE) AS inventory_date, CAST(user_id AS INTEGER) AS product_id
        FROM events WHERE event_type = 'view'
        UNION
        SELECT CAST(ts AS DATE), CAST(user_id AS INTEGER) FROM events WHERE event_type = 'click'""",
    "daily_purchases": _per_day("in", "quantity_received"),
    "daily_sales": _per_day("out", "quantity_sold"),
    "daily_adjustments": _per_day("adj", "quantity_adjusted"),
    "daily_system_stock": _per_day("log", "stock_aktual_system"),
    "opening_stock": f"""
        WITH feed AS ({_DENSE_FEED})
        SELECT day + 1 AS inventory_date, product_id, CAST(sum(units) AS BIGINT) AS stock_awal
        FROM feed WHERE kind = 'log' GROUP BY day, product_id""",
    "inventory_snapshot": f"WITH {_DENSE} SELECT * FROM ledger",
    "inventory_snapshot_wide": f"WITH {_WIDE} SELECT * FROM ledger",
    "moving_metrics": f"WITH {_DENSE} SELECT * FROM rolled",
    "turnover_metrics": f"WITH {_DENSE} SELECT * FROM measured",
    "turnover_metrics_wide": f"WITH {_WIDE} SELECT * FROM measured",
    "speed_class": f"""
        WITH {_WIDE} SELECT sales_speed_class, count(*) AS ledger_rows, count(*) FILTER (reorder_alert) AS alerts,
               CAST(sum(recommended_reorder_qty) AS BIGINT) AS units_to_order
        FROM advised GROUP BY sales_speed_class""",
    "reorder_levels": f"""
        WITH {_chain(_DENSE_FEED, lead=7, safety=2)}
        SELECT inventory_date, product_id, daily_sales_velocity, safety_stock, reorder_point FROM levels""",
    "reorder_analysis": f"WITH {_DENSE} SELECT * FROM advised",
    "reorder_analysis_wide": f"WITH {_WIDE} SELECT * FROM advised",
    "reorder_analysis_sorted": f"WITH {_DENSE} SELECT * FROM advised ORDER BY inventory_date, product_id",
    "movement_fact": f"WITH {_MOVED} SELECT * FROM moved",
    "movement_with_missing_feed": f"WITH {_MOVED} SELECT * FROM moved WHERE movement_type <> 'ADJUSTMENT'",
    "daily_inventory_fact": f"WITH {_DENSE} {_daily_rows('advised', _TY)}",
    "reorder_mart": f"WITH {_DENSE} SELECT * FROM advised WHERE reorder_alert",
    "dq_null_report": f"WITH {_MOVED} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM moved"
        for c in (
            "movement_date",
            "product_id",
            "movement_type",
            "quantity",
            "source_reference_id",
            "supplier_id",
            "unit_price",
        )
    ),
    "dq_duplicate_report": """
        WITH sized AS (SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)
        SELECT count(*) AS row_count, count(*) FILTER (n > 1) AS duplicate_count FROM sized""",
    "dq_business_report": f"""
        WITH {_DENSE}
        SELECT 'stock_awal' AS column_name, count(*) FILTER (stock_awal < 0) AS negative_count FROM ledger
        UNION ALL SELECT 'stock_akhir', count(*) FILTER (stock_akhir < 0) FROM ledger""",
    "dq_gate_report": f"""
        WITH {_DENSE},
        refs AS (
          SELECT count(*) OVER (PARTITION BY CASE WHEN l_linestatus = 'F' THEN 1 WHEN l_returnflag = 'R' THEN 2 ELSE 3 END,
                                l_orderkey * 8 + l_linenumber) AS n
          FROM lineitem INNER JOIN orders ON o_orderkey = l_orderkey WHERE l_linestatus IN ('F', 'O'))
        SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS nulls, CAST(0 AS BIGINT) AS duplicates,
               count(*) FILTER (stock_awal < 0) + count(*) FILTER (stock_akhir < 0) AS biz_warnings, 'daily' AS mart
        FROM ledger
        UNION ALL SELECT count(*), 0, count(*) FILTER (n > 1), 0, 'movement' FROM refs""",
    "supplier_upsert": f"""
        WITH {_SUPPLIERS}
        SELECT supplier_id, code AS supplier_code,
               CASE WHEN supplier_id % 4 <> 0 OR supplier_id % 3 = 0 THEN name || ' Ltd' ELSE name END AS supplier_name,
               email, country,
               CASE WHEN supplier_id % 3 <> 0 THEN TIMESTAMP '2023-01-01 00:00:00' ELSE created_at END AS created_at,
               CASE WHEN supplier_id % 4 <> 0 OR supplier_id % 3 = 0 THEN {_TY} ELSE {_TX} END AS ingestion_date
        FROM suppliers""",
    "product_scd2": f"""
        WITH {_CHANGED}
        SELECT f.product_sk, f.product_id, f.code AS product_code, f.name AS product_name, f.category, f.barcode, f.weight,
               f.is_active, {_TX} AS effective_start_date,
               CASE WHEN c.old_sk IS NULL THEN '9999-12-31 23:59:59' ELSE '2024-02-01 06:00:00' END AS effective_end_date,
               c.old_sk IS NULL AS is_current, {_TX} AS created_at
        FROM first_load AS f LEFT JOIN compared AS c ON c.old_sk = f.product_sk AND c.action = 'change'
        UNION ALL
        SELECT (SELECT count(*) FROM products) + row_number() OVER (ORDER BY product_id), product_id, code, name, category,
               barcode, CAST(weight AS DECIMAL(10,2)), is_active, {_TY}, '9999-12-31 23:59:59', TRUE, {_TY}
        FROM compared WHERE action <> 'keep'""",
    "product_changes": f"WITH {_CHANGED} SELECT action, count(*) AS products FROM compared GROUP BY action",
    "movement_upsert": f"""
        WITH {_MOVED}
        SELECT source_reference_id * 4 + CASE movement_type WHEN 'INBOUND' THEN 0 WHEN 'OUTBOUND' THEN 1 ELSE 2 END
                 AS movement_id,
               movement_date, product_id, supplier_id, movement_type,
               CASE WHEN movement_date >= DATE '2024-01-15' THEN quantity + 1 ELSE quantity END AS quantity, unit_price,
               total_amount, source_reference_id,
               CASE WHEN movement_date >= DATE '2024-01-15' THEN {_TY} ELSE {_TX} END AS ingestion_date,
               source_reference_id // 4096 AS ref_bucket
        FROM moved""",
    "daily_fact_upsert": f"""
        WITH {_DENSE}, {_chain(_DENSE_FEED, tag="_new", since="2024-01-15")}
        {_daily_rows("(SELECT * FROM advised WHERE inventory_date < DATE '2024-01-15')", _TX)}
        UNION ALL {_daily_rows("advised_new", _TY)}""",
    "read_watermark": f"""
        WITH {_STATE}
        SELECT coalesce(max(last_success_date), DATE '2024-02-01' - 30) AS last_success_date
        FROM state WHERE pipeline_name = 'user-7'""",
    "watermark_upsert": f"""
        WITH {_STATE}
        SELECT pipeline_name, CASE WHEN user_id % 2 = 0 OR user_id % 3 = 0 THEN last_success_date + 1
                                   ELSE last_success_date END AS last_success_date,
               CASE WHEN user_id % 2 = 0 OR user_id % 3 = 0 THEN {_TY} ELSE updated_at END AS updated_at
        FROM state""",
    "audit_log": f"WITH {_RUNS} SELECT * FROM runs",
    "latest_running_run": f"""
        WITH {_RUNS} SELECT run_id, pipeline_name, start_time FROM runs WHERE run_status = 'RUNNING'
        ORDER BY start_time DESC, run_id DESC LIMIT 1""",
    "two_daily_runs": f"""
        WITH {_DENSE}, {_chain(_DENSE_FEED, tag="_new", since="2024-01-20")}
        {_daily_rows("(SELECT * FROM advised WHERE inventory_date < DATE '2024-01-20')", _TX)}
        UNION ALL {_daily_rows("advised_new", _TY)}""",
    "pipeline_end_to_end_movements": f"""
        WITH {_MOVED}
        SELECT source_reference_id * 4 + CASE movement_type WHEN 'INBOUND' THEN 0 WHEN 'OUTBOUND' THEN 1 ELSE 2 END
                 AS movement_id,
               movement_date, product_id, supplier_id, movement_type, quantity, unit_price, total_amount,
               source_reference_id,
               CASE WHEN movement_date >= DATE '2024-01-20' THEN {_TY} ELSE {_TX} END AS ingestion_date,
               source_reference_id // 16777216 AS ref_bucket
        FROM moved""",
    "pipeline_end_to_end_state": f"""
        SELECT 'retail_inventory_pipeline' AS pipeline_name, DATE '2024-01-20' AS last_success_date, {_TX} AS updated_at""",
    "pipeline_end_to_end_audit": f"""
        WITH {_DENSE},
        sizes AS (SELECT (SELECT count(*) FROM part) AS products, (SELECT count(*) FROM supplier) AS suppliers,
                         (SELECT count(*) FROM feed) AS events, (SELECT count(*) FROM ledger) AS days,
                         (SELECT count(*) FROM feed WHERE kind <> 'log') AS movements)
        SELECT 'retail_inventory_pipeline' AS pipeline_name, 'SUCCESS' AS run_status,
               products + suppliers + events AS records_extracted, products + suppliers + movements + days AS records_loaded,
               3 AS dq_checks_passed, 0 AS dq_checks_failed, CAST(NULL AS VARCHAR) AS error_message
        FROM sizes""",
    "pipeline_end_to_end_reorder_mart": f"WITH {_DENSE} SELECT * FROM advised WHERE reorder_alert",
    "pipeline_end_to_end_gated": f"""
        WITH {_DENSE}
        SELECT 'FAILED' AS run_status, 2 AS dq_checks_passed, 1 AS dq_checks_failed,
               (SELECT count(*) FROM part) + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM feed)
                 + (SELECT count(*) FROM feed WHERE kind = 'out') AS records_extracted,
               CAST(0 AS BIGINT) AS records_loaded, CAST(0 AS BIGINT) AS daily_rows, CAST(0 AS BIGINT) AS movement_rows""",
    "pipeline_end_to_end_stale": f"""
        WITH {_DENSE}
        SELECT DATE '2024-01-20' AS last_success_date, 'DataQualityError,UncheckedMartError' AS refused,
               CAST(1 AS BIGINT) AS runs_success, CAST(1 AS BIGINT) AS runs_failed, CAST(0 AS BIGINT) AS runs_running,
               (SELECT count(*) FROM ledger) AS daily_rows, (SELECT count(*) FROM feed WHERE kind <> 'log') AS movement_rows""",
    "pipeline_manifest": f"""
        WITH {_chain(_DENSE_FEED, since="2024-01-20")},
        raw (name, kind) AS (VALUES ('sales', 'out'), ('purchases', 'in'), ('adjustments', 'adj'), ('stock_daily', 'log'))
        SELECT 'raw/' || name AS set_name, CAST(NULL AS BIGINT) AS set_version,
               (SELECT count(*) FROM feed WHERE feed.kind = raw.kind) AS set_rows, 'extracted' AS verdict FROM raw
        UNION ALL SELECT 'raw/products', NULL, count(*), 'extracted' FROM part
        UNION ALL SELECT 'raw/suppliers', NULL, count(*), 'extracted' FROM supplier
        UNION ALL SELECT 'staging/reorder_recommendation', NULL, count(*), 'transformed' FROM advised
        UNION ALL SELECT 'mart/fact_daily_inventory', 2, count(*), 'passed' FROM advised
        UNION ALL SELECT 'mart/reorder_recommendations', 2, count(*), 'passed' FROM advised WHERE reorder_alert
        UNION ALL SELECT 'mart/fact_inventory_movement', 2, count(*), 'passed' FROM feed WHERE kind <> 'log'""",
    "snapshot_isolation": f"""
        WITH {_MOVED},
        versions AS (
          SELECT 1 AS version, movement_date, quantity FROM moved
          UNION ALL SELECT 2, movement_date, CASE WHEN movement_date >= DATE '2024-01-20' THEN quantity * 10 ELSE quantity END FROM moved
          UNION ALL
          SELECT 3, movement_date, CASE WHEN movement_date >= DATE '2024-01-20' THEN quantity * 10
                                        WHEN movement_date < DATE '2024-01-15' THEN 1 ELSE quantity END FROM moved)
        SELECT version, movement_date, count(*) AS movements, CAST(sum(quantity) AS BIGINT) AS units
        FROM versions GROUP BY version, movement_date""",
    "thirty_daily_runs": f"WITH {_DENSE} SELECT * FROM advised",
    "audit_log_folded": f"WITH {_RUNS} SELECT * FROM runs",
    "watermark_fold": """
        SELECT 'user-' || user_id AS pipeline_name, CAST(CAST(ts AS DATE) - 1 AS DATE) AS last_success_date, ts AS updated_at
        FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1""",
    "late_movements": f"""
        WITH {_MOVED}, marked AS (
          SELECT *, movement_date >= DATE '2024-01-20' OR source_reference_id % 997 = 0 AS late FROM moved)
        SELECT source_reference_id * 4 + CASE movement_type WHEN 'INBOUND' THEN 0 WHEN 'OUTBOUND' THEN 1 ELSE 2 END
                 AS movement_id,
               movement_date, product_id, supplier_id, movement_type,
               CASE WHEN late THEN quantity + 1 ELSE quantity END AS quantity, unit_price, total_amount, source_reference_id,
               CASE WHEN late THEN {_TY} ELSE {_TX} END AS ingestion_date, source_reference_id // 1024 AS ref_bucket
        FROM marked""",
}

# Money and rates are compared as doubles, as the registered queries show them.
_DECIMALS = {
    ("scan_products", "product_scd2"): ["weight"],
    ("incremental_sales",): ["unit_price", "discount", "total_amount"],
    ("incremental_purchases",): ["unit_price"],
    (
        "movement_fact",
        "movement_with_missing_feed",
        "movement_upsert",
        "movement_upsert_in_place",
        "late_movements",
        "pipeline_end_to_end_movements",
    ): ["unit_price", "total_amount"],
    ("daily_inventory_fact", "daily_fact_upsert", "two_daily_runs"): [
        "daily_sales_velocity",
        "days_of_inventory",
        "inventory_turnover_rate",
    ],
}

for _merged in ("supplier_upsert", "movement_upsert"):
    ORACLES[f"{_merged}_in_place"] = ORACLES[_merged]

for _names, _columns in _DECIMALS.items():
    _casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _columns)
    for _name in _names:
        ORACLES[_name] = f"SELECT * REPLACE ({_casts}) FROM ({ORACLES[_name]}) AS exact"
