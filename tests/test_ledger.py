from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.operators import ledger

DAY = date(2026, 6, 2)


def feed(spark, name, rows):
    """Rows given as dictionaries; columns that a row does not name are NULL."""
    columns = [part.split()[0] for part in schemas.RAW[name].split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schemas.RAW[name])


def at(day, hour=8):
    return datetime(day.year, day.month, day.day, hour) if day else None


def snapshot(spark, stock=(), received=(), sold=(), adjusted=()):
    """Each feed as (product, day, quantity[, location or hour]) tuples."""
    stock_rows = [
        {"product_id": p, "created_date": at(d, *h), "onhand_quantity": q, "location_code": "A"} for p, d, q, *h in stock
    ]
    result = ledger.inventory_snapshot(
        feed(spark, "stock_daily", stock_rows),
        feed(spark, "purchases", [{"product_id": p, "received_date": at(d), "received_quantity": q} for p, d, q in received]),
        feed(spark, "sales", [{"product_id": p, "transaction_date": at(d), "quantity": q} for p, d, q in sold]),
        feed(spark, "adjustments", [{"product_id": p, "adjustment_date": at(d), "quantity": q} for p, d, q in adjusted]),
    )
    return {(r["inventory_date"], r["product_id"]): r for r in result.collect()}


@pytest.mark.parametrize(
    ("opening", "received", "sold", "adjusted", "closing"),
    [(100, 50, 20, 0, 130), (100, 30, 15, -2, 113), (50, 0, 0, 0, 50), (10, 0, 0, 3, 13)],
)
def test_closing_stock(spark, opening, received, sold, adjusted, closing):
    before = date(2026, 6, 1)
    row = snapshot(
        spark,
        stock=[(1, before, opening), (1, DAY, closing)],
        received=[(1, DAY, received)],
        sold=[(1, DAY, sold)],
        adjusted=[(1, DAY, adjusted)],
    )[DAY, 1]
    assert (row["stock_awal"], row["stock_akhir"], row["stock_aktual_system"], row["selisih"]) == (
        opening,
        closing,
        closing,
        0,
    )


def test_movements_without_a_stock_log_are_dropped(spark):
    rows = snapshot(spark, stock=[(1, DAY, 5)], sold=[(2, DAY, 3), (1, date(2026, 6, 3), 4)])
    assert set(rows) == {(DAY, 1)}
    assert rows[DAY, 1]["quantity_sold"] == 0


def test_opening_stock_needs_the_log_of_the_day_before(spark):
    rows = snapshot(spark, stock=[(1, date(2026, 5, 31), 70), (1, DAY, 60), (1, date(2026, 6, 3), 50)])
    assert rows[DAY, 1]["stock_awal"] == 0
    assert rows[date(2026, 6, 3), 1]["stock_awal"] == 60


def test_reported_stock_sums_all_logs_of_a_day(spark):
    rows = snapshot(spark, stock=[(1, DAY, 5, 1), (1, DAY, 7, 2), (1, DAY, 11, 23)])
    assert rows[DAY, 1]["stock_aktual_system"] == 23


def test_logs_without_a_key_keep_a_row_of_zeros(spark):
    rows = snapshot(spark, stock=[(None, DAY, 9), (1, None, 9), (1, DAY, 4)], sold=[(None, DAY, 2), (1, None, 2)])
    assert set(rows) == {(DAY, None), (None, 1), (DAY, 1)}
    for key in ((DAY, None), (None, 1)):
        assert rows[key]["stock_aktual_system"] == rows[key]["quantity_sold"] == rows[key]["stock_akhir"] == 0


def test_null_quantities_count_as_nothing(spark):
    rows = snapshot(spark, stock=[(1, DAY, None), (1, DAY, 4)], received=[(1, DAY, None)])
    assert (rows[DAY, 1]["stock_aktual_system"], rows[DAY, 1]["quantity_received"]) == (4, 0)


def test_equals_the_join_form_with_a_hot_product(spark):
    """One product holds a third of all rows; the stacked form equals plain aggregates and left joins."""
    ids = spark.range(30_000)
    product = F.when(F.col("id") % 3 == 0, 0).otherwise(F.hash("id", F.lit(1)) % 40).cast("int")
    day = F.date_add(F.lit(date(2026, 1, 1)), (F.pmod(F.hash("id", F.lit(2)), F.lit(90))).cast("int"))
    rows = ids.select(
        product.alias("product_id"),
        day.cast("timestamp_ntz").alias("t"),
        F.pmod(F.hash("id", F.lit(3)), F.lit(50)).cast("int").alias("q"),
        F.pmod(F.hash("id", F.lit(4)), F.lit(4)).alias("kind"),
    )
    stock = rows.filter("kind = 0").select("product_id", F.col("t").alias("created_date"), F.col("q").alias("onhand_quantity"))
    received = rows.filter("kind = 1").select("product_id", F.col("t").alias("received_date"), F.col("q").alias("received_quantity"))
    sold = rows.filter("kind = 2").select("product_id", F.col("t").alias("transaction_date"), F.col("q").alias("quantity"))
    adjusted = rows.filter("kind = 3").select("product_id", F.col("t").alias("adjustment_date"), F.col("q").alias("quantity"))
    keys = ["inventory_date", "product_id"]
    joined = ledger.date_product_spine(stock)
    for part in (
        ledger.opening_stock(stock),
        ledger.daily_purchases(received),
        ledger.daily_sales(sold),
        ledger.daily_adjustments(adjusted),
        ledger.daily_system_stock(stock),
    ):
        joined = joined.join(part, keys, "left")
    joined = joined.fillna(0).withColumn("stock_akhir", ledger.closing_stock())
    joined = joined.withColumn("selisih", F.col("stock_aktual_system") - F.col("stock_akhir"))
    joined = joined.select(*ledger.LEDGER_COLUMNS)
    stacked = ledger.inventory_snapshot(stock, received, sold, adjusted)
    assert stacked.count() == joined.count() > 1000
    assert stacked.exceptAll(joined).count() == 0
