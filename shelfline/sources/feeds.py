"""Projections and incremental filters of the source tables.

They take any scan, Parquet or JDBC; column lists and date predicates are pushed down to it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

# The columns each feed takes from its source table.
PRODUCT_COLUMNS = ["product_id", "code", "name", "category", "barcode", "weight", "is_active", "created_at"]
SUPPLIER_COLUMNS = ["supplier_id", "code", "name", "email", "country", "created_at"]
SALES_COLUMNS = [
    "transaction_id",
    "transaction_number",
    "transaction_date",
    "product_id",
    "quantity",
    "unit_price",
    "discount",
    "total_amount",
    "created_at",
]
PURCHASE_COLUMNS = [
    "po_detail_id",
    "po_header_id",
    "po_number",
    "supplier_id",
    "order_date",
    "product_id",
    "quantity",
    "unit_price",
    "received_quantity",
    "received_date",
]
ADJUSTMENT_COLUMNS = [
    "adjustment_id",
    "adjustment_number",
    "adjustment_date",
    "product_id",
    "quantity",
    "reason",
    "created_at",
]
STOCK_COLUMNS = ["product_id", "location_code", "onhand_quantity", "created_date"]


def products(product: DataFrame) -> DataFrame:
    return product.select(*PRODUCT_COLUMNS)


def suppliers(supplier: DataFrame) -> DataFrame:
    return supplier.select(*SUPPLIER_COLUMNS)


def incremental_sales(sales_transaction: DataFrame, since: date) -> DataFrame:
    return _since(sales_transaction, "transaction_date", since).select(*SALES_COLUMNS)


def incremental_purchases(detail: DataFrame, header: DataFrame, since: date) -> DataFrame:
    """Order lines received since the watermark with their order's number, supplier and date.

    Headers are unique by id, so the join never multiplies rows. Spark broadcasts the headers only if they
    measure below its threshold; in the shuffled form AQE splits an order that holds very many lines.
    """
    received = _since(detail, "received_date", since)
    headers = header.select("po_header_id", "po_number", "supplier_id", "order_date")
    return received.join(headers, "po_header_id").select(*PURCHASE_COLUMNS)


def incremental_adjustments(stock_adjustment: DataFrame, since: date) -> DataFrame:
    return _since(stock_adjustment, "adjustment_date", since).select(*ADJUSTMENT_COLUMNS)


def incremental_stock_daily(stock_daily: DataFrame, since: date) -> DataFrame:
    return _since(stock_daily, "created_date", since).select(*STOCK_COLUMNS)


def _since(table: DataFrame, event_column: str, since: date) -> DataFrame:
    """Rows whose event lies on or after the watermark day. The time of modification plays no part."""
    return table.filter(F.col(event_column) >= F.lit(since).cast("timestamp_ntz"))
