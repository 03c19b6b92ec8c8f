"""Reorder advice from velocity, lead time and safety days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.config import DEFAULT_LEAD_TIME_DAYS, DEFAULT_SAFETY_STOCK_DAYS
from shelfline.operators.metrics import METRIC_COLUMNS

ADVICE_COLUMNS = [*METRIC_COLUMNS, "reorder_alert", "recommended_reorder_qty"]


def safety_stock(safety_stock_days: int) -> Column:
    return F.round(F.col("daily_sales_velocity") * F.lit(safety_stock_days), 0)


def reorder_point(lead_time_days: int, safety_stock_days: int) -> Column:
    """Demand of lead time and safety days, rounded once."""
    velocity = F.col("daily_sales_velocity")
    return F.round(velocity * F.lit(lead_time_days) + velocity * F.lit(safety_stock_days), 0)


def reorder_levels(
    metrics: DataFrame,
    lead_time_days: int = DEFAULT_LEAD_TIME_DAYS,
    safety_stock_days: int = DEFAULT_SAFETY_STOCK_DAYS,
) -> DataFrame:
    return metrics.withColumns(
        {
            "safety_stock": safety_stock(safety_stock_days),
            "reorder_point": reorder_point(lead_time_days, safety_stock_days),
        }
    )


def reorder_analysis(
    metrics: DataFrame,
    lead_time_days: int = DEFAULT_LEAD_TIME_DAYS,
    safety_stock_days: int = DEFAULT_SAFETY_STOCK_DAYS,
) -> DataFrame:
    """Metrics plus the reorder alert and the quantity to order; further columns pass through.

    The quantity fills up to the reorder point plus the safety stock, although the reorder point holds the
    safety stock already.
    """
    flags = [c for c in metrics.columns if c not in ADVICE_COLUMNS]
    missing_units = F.col("reorder_point") - F.col("stock_akhir") + F.col("safety_stock")
    return (
        reorder_levels(metrics, lead_time_days, safety_stock_days)
        .withColumn("reorder_alert", F.coalesce(F.col("stock_akhir") < F.col("reorder_point"), F.lit(False)))
        .withColumn(
            "recommended_reorder_qty", F.when(F.col("reorder_alert"), missing_units.cast("int")).otherwise(F.lit(0))
        )
        .select(*ADVICE_COLUMNS, *flags)
    )
