"""Keyed upserts into the warehouse tables, as joins."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.functions.keys import daily_key, movement_key

# Merge keys of the warehouse tables.
SUPPLIER_KEY = ("supplier_id",)
MOVEMENT_KEY = ("movement_type", "source_reference_id")
DAILY_KEY = ("inventory_date", "product_id")
STATE_KEY = ("pipeline_name",)

#: Most feed rows whose keys go to every task that scans the target. Keys are a few fixed-width values and a short word,
#: about 100 bytes each once hashed, so that is 50 MB.
STREAMED_ROWS = 500_000


def merge_upsert(
    target: DataFrame, feed: DataFrame, keys: Sequence[str], keep_on_conflict: Sequence[str] = ()
) -> DataFrame:
    """Target rows without a feed row, plus all feed rows: one full outer join, so each side is evaluated once.

    Keys are unique on both sides and not NULL (`quality.require_unique` for the feed), so the hashed rows are even. Columns in
    `keep_on_conflict` hold on to the target's value where the key exists already.
    """
    old = target.select(F.lit(True).alias("_known"), *[F.col(c).alias(f"_old_{c}") for c in target.columns])
    new = feed.select(F.lit(True).alias("_fed"), *target.columns)
    match = [F.col(f"_old_{k}") == F.col(k) for k in keys]
    merged = old.join(new, match, "full_outer")
    return merged.select(
        *[
            F.when(F.col("_fed") & F.col("_known"), F.col(f"_old_{c}")).when(F.col("_fed"), F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c)
            if c in keep_on_conflict
            else F.when(F.col("_fed"), F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c)
            for c in target.columns
        ]
    )


def merge_in_place(
    target: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    feed_rows: int,
    spread_by: Sequence[str] = (),
    keep_on_conflict: Sequence[str] = (),
    most: int = STREAMED_ROWS,
) -> tuple[DataFrame, bool]:
    """The rows of `merge_upsert`, and whether the target's rows stay in the tasks that scan them.

    They do if the feed is small by its counted rows (`feed_rows`): its keys are broadcast, target rows that have one of them
    go, and the feed's rows are added. Only those are exchanged, by `spread_by`, so a merge of a few rows into large
    partitions moves a few rows, and a hot key or partition of the target is never gathered. A larger feed takes the
    full outer join. The feed is evaluated twice, so it should be a stored set; keys are unique and not NULL as there.
    """
    if feed_rows > most:
        return merge_upsert(target, feed, keys, keep_on_conflict), False
    names = target.columns
    fed = F.broadcast(feed.select(*keys))
    rows = feed.select(*names)
    if keep_on_conflict:
        # What the target holds on to: as many rows at most as the feed has.
        held = target.join(fed, list(keys), "left_semi")
        held = held.select(F.lit(True).alias("_known"), *keys, *(F.col(c).alias(f"_old_{c}") for c in keep_on_conflict))
        first = {c: F.when(F.col("_known"), F.col(f"_old_{c}")).otherwise(F.col(c)) for c in keep_on_conflict}
        rows = rows.join(held, list(keys), "left").withColumns(first).select(*names)
    if spread_by:
        rows = rows.hint("rebalance", *[F.col(c) for c in spread_by])
    return target.join(fed, list(keys), "left_anti").select(*names).unionByName(rows), True


def supplier_rows(suppliers: DataFrame, as_of: Column) -> DataFrame:
    """Supplier feed in the shape of the dimension."""
    return suppliers.select(
        F.col("supplier_id").cast("int").alias("supplier_id"),
        F.col("code").alias("supplier_code"),
        F.col("name").alias("supplier_name"),
        "email",
        "country",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        as_of.alias("ingestion_date"),
    )


def supplier_upsert(target: DataFrame, suppliers: DataFrame, as_of: Column) -> DataFrame:
    """Type 1 dimension: everything but the creation time follows the feed."""
    return merge_upsert(target, supplier_rows(suppliers, as_of), SUPPLIER_KEY, keep_on_conflict=["created_at"])


def movement_rows(movements: DataFrame, as_of: Column, bucket_span: int) -> DataFrame:
    """Movement mart in the shape of the fact, with its key and the bucket of its reference.

    References grow over time, so a daily feed falls into the newest buckets of each type. The bucket is
    a function of the merge key: a row never moves between partitions.
    """
    reference = F.col("source_reference_id")
    return movements.withColumns(
        {
            "movement_id": movement_key(F.col("movement_type"), reference),
            "ingestion_date": as_of,
            "ref_bucket": F.floor(reference / F.lit(bucket_span)).cast("bigint"),
        }
    )


def movement_upsert(target: DataFrame, movements: DataFrame, as_of: Column, bucket_span: int) -> DataFrame:
    return merge_upsert(target, movement_rows(movements, as_of, bucket_span), MOVEMENT_KEY)


# Column types of the daily fact at the sink.
_DAILY_COUNTS = [
    "stock_awal",
    "quantity_received",
    "quantity_sold",
    "quantity_adjusted",
    "stock_akhir",
    "stock_aktual_system",
    "selisih",
    "recommended_reorder_qty",
]
_DAILY_RATES = ["daily_sales_velocity", "days_of_inventory", "inventory_turnover_rate"]


def daily_rows(daily: DataFrame, as_of: Column) -> DataFrame:
    """Daily mart in the shape of the fact, with its key and sink types."""
    return daily.withColumns(
        {
            "id": daily_key(F.col("inventory_date"), F.col("product_id")),
            **{c: F.col(c).cast("int") for c in _DAILY_COUNTS},
            **{c: F.col(c).cast("decimal(10,2)") for c in _DAILY_RATES},
            "ingestion_date": as_of,
        }
    )


def daily_fact_upsert(target: DataFrame, daily: DataFrame, as_of: Column) -> DataFrame:
    return merge_upsert(target, daily_rows(daily, as_of), DAILY_KEY)


def watermark_rows(spark: SparkSession, pipeline_name: str, day: date, as_of: Column) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(
        F.lit(pipeline_name).alias("pipeline_name"),
        F.lit(day).cast("date").alias("last_success_date"),
        as_of.alias("updated_at"),
    )


def watermark_upsert(target: DataFrame, state: DataFrame) -> DataFrame:
    return merge_upsert(target, state, STATE_KEY)
