"""Domain tables as views over the sample Parquet tables, used by the registered queries, tests and bench.

`dense` reads `events`: few products, many rows per product and day. `wide` reads `lineitem`: many products,
about one row per product and day. Each gives the trade and stock tables of `shelfline.schemas.SOURCE`;
`with_dimensions` adds products and suppliers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.sources.files import scan_set

# Columns of the sample tables. Stating them saves the pass that infers them.
SAMPLE = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
        " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
        " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
        " l_shipdate TIMESTAMP_NTZ"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_set(spark, f"{sf_dir}/{name}.parquet", SAMPLE[name])


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "int(p_partkey) AS product_id",
        "concat('PRD-', p_partkey) AS code",
        "p_name AS name",
        "p_type AS category",
        "p_brand AS barcode",
        "cast(p_size AS DECIMAL(10,2)) AS weight",
        "p_partkey % 10 <> 0 AS is_active",
        "timestamp_ntz'2024-01-01 00:00:00' AS created_at",
    )


def changed_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later product feed: weights, categories and flags changed, some products gone, new ones added."""
    base = product(spark, sf_dir)
    kept = base.filter("product_id % 13 <> 0").selectExpr(
        "product_id",
        "code",
        "name",
        "CASE WHEN product_id % 11 = 0 THEN concat(category, ' II') ELSE category END AS category",
        "barcode",
        "CASE WHEN product_id % 7 = 0 THEN weight + 1 WHEN product_id % 17 <> 0 THEN weight END AS weight",
        "CASE WHEN product_id % 19 = 0 THEN NOT is_active ELSE is_active END AS is_active",
        "created_at",
    )
    added = base.filter("product_id % 20 = 0").selectExpr(
        "product_id + 1000000 AS product_id",
        "concat('PRD-', product_id + 1000000) AS code",
        "name",
        "category",
        "barcode",
        "weight",
        "is_active",
        "created_at",
    )
    return kept.unionByName(added)


def supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS s_nationkey", "n_name")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, "s_nationkey", "left")
        .selectExpr(
            "int(s_suppkey) AS supplier_id",
            "concat('SUP-', s_suppkey) AS code",
            "s_name AS name",
            "CASE WHEN s_suppkey % 5 <> 0 THEN concat('s', s_suppkey, '@example.com') END AS email",
            "n_name AS country",
            "timestamp_ntz'2024-01-01 00:00:00' AS created_at",
        )
    )


def _cents(amount: str) -> str:
    return f"cast(cast({amount} AS DECIMAL(10,0)) * 0.01 AS DECIMAL(12,2))"


def dense(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = table(spark, sf_dir, "events")
    units, item, price = "int(floor(value))", "int(user_id) AS product_id", _cents("event_id % 9000 + 500")
    discount = f"CASE WHEN event_id % 4 = 0 THEN {_cents('50')} ELSE {_cents('0')} END"
    receipts = events.filter("event_type = 'signup'")
    return {
        "purchase_order_header": receipts.selectExpr(
            "event_id AS po_header_id",
            "concat('PO-', event_id) AS po_number",
            "int(user_id % 5 + 1) AS supplier_id",
            "date(ts) AS order_date",
            "'COMPLETED' AS status",
            "ts AS created_at",
        ),
        "purchase_order_detail": receipts.selectExpr(
            "event_id AS po_detail_id",
            "event_id AS po_header_id",
            item,
            f"{units} AS quantity",
            f"{price} AS unit_price",
            f"{units} AS received_quantity",
            "ts AS received_date",
        ),
        "sales_transaction": events.filter("event_type = 'purchase'").selectExpr(
            "event_id AS transaction_id",
            "concat('TX-', event_id) AS transaction_number",
            "ts AS transaction_date",
            item,
            f"{units} AS quantity",
            f"{price} AS unit_price",
            f"cast({discount} AS DECIMAL(5,2)) AS discount",
            f"cast({units} * ({price} - {discount}) AS DECIMAL(12,2)) AS total_amount",
            "ts AS created_at",
        ),
        "stock_adjustment": events.filter("event_type = 'error'").selectExpr(
            "event_id AS adjustment_id",
            "concat('ADJ-', event_id) AS adjustment_number",
            "ts AS adjustment_date",
            item,
            "int(event_id % 7 - 3) AS quantity",
            "'count' AS reason",
            "ts AS created_at",
        ),
        "stock_daily": events.filter("event_type IN ('view', 'click')").selectExpr(
            item, "event_type AS location_code", f"{units} + 40 AS onhand_quantity", "ts AS created_date"
        ),
    }


def wide(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    lines = table(spark, sf_dir, "lineitem")
    key, units, item = "l_orderkey * 8 + l_linenumber", "int(l_quantity)", "int(l_partkey) AS product_id"
    price = _cents("floor(l_extendedprice)")
    return {
        "purchase_order_header": table(spark, sf_dir, "orders").selectExpr(
            "o_orderkey AS po_header_id",
            "concat('PO-', o_orderkey) AS po_number",
            "int(o_custkey % 100) AS supplier_id",
            "date(o_orderdate) AS order_date",
            "'COMPLETED' AS status",
            "o_orderdate AS created_at",
        ),
        "purchase_order_detail": lines.filter("l_linestatus = 'F'").selectExpr(
            f"{key} AS po_detail_id",
            "l_orderkey AS po_header_id",
            item,
            f"{units} AS quantity",
            f"{price} AS unit_price",
            f"{units} AS received_quantity",
            "l_shipdate AS received_date",
        ),
        "sales_transaction": lines.filter("l_linestatus = 'O' AND l_returnflag <> 'R'").selectExpr(
            f"{key} AS transaction_id",
            f"concat('TX-', {key}) AS transaction_number",
            "l_shipdate AS transaction_date",
            item,
            f"{units} AS quantity",
            f"{price} AS unit_price",
            "cast(0 AS DECIMAL(5,2)) AS discount",
            f"cast({units} * {price} AS DECIMAL(12,2)) AS total_amount",
            "l_shipdate AS created_at",
        ),
        "stock_adjustment": lines.filter("l_linestatus = 'O' AND l_returnflag = 'R'").selectExpr(
            f"{key} AS adjustment_id",
            f"concat('ADJ-', {key}) AS adjustment_number",
            "l_shipdate AS adjustment_date",
            item,
            f"-1 - {units} % 3 AS quantity",
            "'returned' AS reason",
            "l_shipdate AS created_at",
        ),
        "stock_daily": lines.selectExpr(
            item, "l_returnflag AS location_code", f"{units} + 40 AS onhand_quantity", "l_shipdate AS created_date"
        ),
    }


def with_dimensions(spark: SparkSession, sf_dir: str, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {"product": product(spark, sf_dir), "supplier": supplier(spark, sf_dir), **tables}


def raw_purchases(tables: dict[str, DataFrame]) -> DataFrame:
    """The whole joined purchase feed, without a watermark."""
    headers = tables["purchase_order_header"].select("po_header_id", "po_number", "supplier_id", "order_date")
    return tables["purchase_order_detail"].join(headers, "po_header_id")
