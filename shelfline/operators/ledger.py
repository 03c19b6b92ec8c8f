"""Daily stock ledger: opening, received, sold, adjusted, closing and reported stock per product."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

LEDGER_COLUMNS = [
    "inventory_date",
    "product_id",
    "stock_awal",
    "quantity_received",
    "quantity_sold",
    "quantity_adjusted",
    "stock_akhir",
    "stock_aktual_system",
    "selisih",
]

_MEASURES = ["quantity_received", "quantity_sold", "quantity_adjusted", "stock_aktual_system"]


def daily_totals(feed: DataFrame, event_column: str, quantity_column: str, total: str) -> DataFrame:
    """Sum of a quantity per (day, product)."""
    return feed.groupBy(F.col(event_column).cast("date").alias("inventory_date"), "product_id").agg(
        F.sum(F.col(quantity_column).cast("bigint")).alias(total)
    )


def daily_purchases(purchases: DataFrame) -> DataFrame:
    return daily_totals(purchases, "received_date", "received_quantity", "quantity_received")


def daily_sales(sales: DataFrame) -> DataFrame:
    return daily_totals(sales, "transaction_date", "quantity", "quantity_sold")


def daily_adjustments(adjustments: DataFrame) -> DataFrame:
    return daily_totals(adjustments, "adjustment_date", "quantity", "quantity_adjusted")


def daily_system_stock(stock_daily: DataFrame) -> DataFrame:
    """Reported stock, summed over locations and over all logs of a day."""
    return daily_totals(stock_daily, "created_date", "onhand_quantity", "stock_aktual_system")


def opening_stock(stock_daily: DataFrame) -> DataFrame:
    """Reported stock carried to the next calendar day."""
    return daily_system_stock(stock_daily).select(
        F.date_add("inventory_date", 1).alias("inventory_date"),
        "product_id",
        F.col("stock_aktual_system").alias("stock_awal"),
    )


def date_product_spine(stock_daily: DataFrame) -> DataFrame:
    """The (day, product) pairs that have a stock log: the row set of the ledger."""
    return stock_daily.select(F.col("created_date").cast("date").alias("inventory_date"), "product_id").distinct()


def product_timeline() -> Window:
    """Rows of one product in date order. One row per calendar day bounds such a group."""
    return Window.partitionBy("product_id").orderBy(F.col("inventory_date").asc_nulls_last())


def inventory_snapshot(
    stock_daily: DataFrame, purchases: DataFrame, sales: DataFrame, adjustments: DataFrame
) -> DataFrame:
    """The ledger, one row per pair of the spine.

    The four feeds are stacked into one narrow set and summed once per (product, day): a single combine
    instead of five aggregates and five joins. Spark sums inside each input task first, so what a busy
    product ships is one row per day and task, spread over all partitions by the day. Only the summed
    ledger, at most one row per product and day, is then brought together by product. There the opening
    stock is the reported stock of the row before, if that row is exactly one day older, so the stock log
    is read once.
    """
    daily = daily_figures(stock_daily, purchases, sales, adjustments)
    return (
        daily.withColumn("stock_awal", _opening())
        .withColumn("stock_akhir", closing_stock())
        .withColumn("selisih", F.col("stock_aktual_system") - F.col("stock_akhir"))
        .select(*LEDGER_COLUMNS)
    )


def continued_snapshot(daily: DataFrame, carried: DataFrame) -> DataFrame:
    """The ledger of days that follow `carried`, and the carried rows themselves, told apart by `is_carried`.

    `daily` holds the figures of the new days; `carried` holds ledger rows of earlier ones, whose opening and closing
    stock stand as they are. What comes out is one row per product and day, in the timeline that windows need.
    """
    known = carried.select("product_id", "inventory_date", *_MEASURES, *[F.col(c).alias(f"_{c}") for c in ("stock_awal", "stock_akhir")])
    rows = daily.select("product_id", "inventory_date", *_MEASURES).unionByName(known, allowMissingColumns=True)
    old = F.col("_stock_akhir").isNotNull()
    return (
        rows.withColumn("stock_awal", F.when(old, F.col("_stock_awal")).otherwise(_opening()))
        .withColumn("stock_akhir", F.when(old, F.col("_stock_akhir")).otherwise(closing_stock()))
        .withColumn("selisih", F.col("stock_aktual_system") - F.col("stock_akhir"))
        .select(*LEDGER_COLUMNS, old.alias("is_carried"))
    )


def carried_over(rows: DataFrame, before: date, most: int) -> DataFrame:
    """What the windows of later days can see of a ledger: the last `most` rows of each product before a day."""
    latest = Window.partitionBy("product_id").orderBy(F.desc("inventory_date"))
    ranked = rows.filter(F.col("inventory_date") < F.lit(before)).withColumn("_latest", F.row_number().over(latest))
    return ranked.filter(F.col("_latest") <= most).select(*LEDGER_COLUMNS)


def daily_figures(
    stock_daily: DataFrame, purchases: DataFrame, sales: DataFrame, adjustments: DataFrame
) -> DataFrame:
    """The four feeds summed per (product, day), for the pairs of the spine."""
    lanes = [
        _lane(stock_daily, "created_date", "stock_aktual_system", "onhand_quantity", on_spine=True),
        _lane(purchases, "received_date", "quantity_received", "received_quantity"),
        _lane(sales, "transaction_date", "quantity_sold", "quantity"),
        _lane(adjustments, "adjustment_date", "quantity_adjusted", "quantity"),
    ]
    return (
        reduce(DataFrame.unionByName, lanes)
        .groupBy("product_id", "inventory_date")
        .agg(*[F.sum(m).alias(m) for m in _MEASURES], F.max("_on_spine").alias("_on_spine"))
        .filter("_on_spine = 1")
    )


def _opening() -> Column:
    timeline = product_timeline()
    day_before = F.lag("inventory_date").over(timeline) == F.date_sub("inventory_date", 1)
    return F.when(day_before, F.lag("stock_aktual_system").over(timeline)).otherwise(F.lit(0))


def closing_stock() -> Column:
    return (
        F.col("stock_awal") + F.col("quantity_received") - F.col("quantity_sold") + F.col("quantity_adjusted")
    )


def _lane(
    feed: DataFrame, event_column: str, measure: str, quantity_column: str, on_spine: bool = False
) -> DataFrame:
    """A feed in the common shape, with 0 in the measures it does not have."""
    keyed = f"product_id IS NOT NULL AND {event_column} IS NOT NULL"
    quantity = f"coalesce(bigint({quantity_column}), 0L)"
    if on_spine:
        # A log without a key keeps its ledger row, but nothing ever matches it: all its figures are 0.
        quantity = f"CASE WHEN {keyed} THEN {quantity} ELSE 0L END"
    else:
        feed = feed.filter(keyed)
    return feed.selectExpr(
        "product_id",
        f"date({event_column}) AS inventory_date",
        *[f"{quantity if m == measure else '0L'} AS {m}" for m in _MEASURES],
        f"{int(on_spine)} AS _on_spine",
    )
