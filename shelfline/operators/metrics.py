"""Rolling sales and stock metrics over the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.numeric import round_scaled, safe_ratio
from shelfline.operators.ledger import LEDGER_COLUMNS, product_timeline

# Frame lengths (rows of a product), class limits (days) and the days shown without sales.
VELOCITY_ROWS = 7
STOCK_ROWS = 30
FAST_BELOW_DAYS = 15
SLOW_UP_TO_DAYS = 60
DAYS_WITHOUT_SALES = 999.0

#: Rows of a product that the longest frame reaches back: what a run has to know of the days before it.
CARRIED_ROWS = STOCK_ROWS - 1

METRIC_COLUMNS = [
    *LEDGER_COLUMNS,
    "daily_sales_velocity",
    "days_of_inventory",
    "inventory_turnover_rate",
    "sales_speed_class",
]


def moving_metrics(ledger: DataFrame) -> DataFrame:
    """Sales velocity, average stock and total sales over the last rows of each product."""
    timeline = product_timeline()
    week = timeline.rowsBetween(-(VELOCITY_ROWS - 1), 0)
    month = timeline.rowsBetween(-(STOCK_ROWS - 1), 0)
    return ledger.withColumns(
        {
            "daily_sales_velocity": round_scaled(F.avg("quantity_sold").over(week), 2),
            "avg_stock_30d": F.avg("stock_akhir").over(month),
            "total_sales_30d": F.sum("quantity_sold").over(month),
        }
    )


def turnover_metrics(ledger: DataFrame) -> DataFrame:
    """Ledger plus velocity, days of inventory, turnover rate and speed class; further columns pass through."""
    rated = {
        "days_of_inventory": days_of_inventory(),
        "inventory_turnover_rate": turnover_rate(),
        "sales_speed_class": speed_class(),
    }
    flags = [c for c in ledger.columns if c not in LEDGER_COLUMNS]
    return moving_metrics(ledger).withColumns(rated).select(*METRIC_COLUMNS, *flags)


def days_of_inventory() -> Column:
    return F.when(F.col("daily_sales_velocity") == 0, F.lit(DAYS_WITHOUT_SALES)).otherwise(
        round_scaled(_days_left(), 2)
    )


def turnover_rate() -> Column:
    rate = round_scaled(safe_ratio(F.col("total_sales_30d"), F.col("avg_stock_30d")), 2)
    return F.when(F.col("avg_stock_30d") == 0, F.lit(0.0)).otherwise(rate)


def speed_class() -> Column:
    """Class by the unrounded days left; negative stock counts as fast."""
    days = _days_left()
    return (
        F.when(F.col("daily_sales_velocity") == 0, "STAGNANT")
        .when(days < FAST_BELOW_DAYS, "FAST_MOVING")
        .when(days <= SLOW_UP_TO_DAYS, "SLOW_MOVING")
        .otherwise("STAGNANT")
    )


def _days_left() -> Column:
    return safe_ratio(F.col("stock_akhir"), F.col("daily_sales_velocity"))
