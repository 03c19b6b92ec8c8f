"""Inventory movements: receipts, sales and adjustments in one shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_MONEY = "decimal(12,2)"


def inbound(purchases: DataFrame) -> DataFrame:
    price = F.col("unit_price").cast(_MONEY)
    return _movement(
        purchases,
        "INBOUND",
        event="received_date",
        quantity="received_quantity",
        reference="po_detail_id",
        supplier=F.col("supplier_id"),
        price=price,
        amount=F.col("received_quantity") * price,
    )


def outbound(sales: DataFrame) -> DataFrame:
    """Sales keep their positive quantity and their own, already discounted, total."""
    return _movement(
        sales,
        "OUTBOUND",
        event="transaction_date",
        quantity="quantity",
        reference="transaction_id",
        price=F.col("unit_price"),
        amount=F.col("total_amount"),
    )


def adjustment(adjustments: DataFrame) -> DataFrame:
    """Adjustments keep their sign and have no supplier, price or amount."""
    return _movement(
        adjustments, "ADJUSTMENT", event="adjustment_date", quantity="quantity", reference="adjustment_id"
    )


def inventory_movements(purchases: DataFrame, sales: DataFrame, adjustments: DataFrame) -> DataFrame:
    """All movements. An absent feed is an empty set of its schema (`sources.files.scan_or_empty`)."""
    return inbound(purchases).unionByName(outbound(sales)).unionByName(adjustment(adjustments))


def _movement(
    feed: DataFrame,
    movement_type: str,
    event: str,
    quantity: str,
    reference: str,
    supplier: Column | None = None,
    price: Column | None = None,
    amount: Column | None = None,
) -> DataFrame:
    absent = F.lit(None)
    return feed.select(
        F.col(event).cast("date").alias("movement_date"),
        F.col("product_id").cast("int").alias("product_id"),
        (absent if supplier is None else supplier).cast("int").alias("supplier_id"),
        F.lit(movement_type).alias("movement_type"),
        F.col(quantity).cast("int").alias("quantity"),
        (absent if price is None else price).cast(_MONEY).alias("unit_price"),
        (absent if amount is None else amount).cast(_MONEY).alias("total_amount"),
        F.col(reference).cast("bigint").alias("source_reference_id"),
    )
