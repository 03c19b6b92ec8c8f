"""Product dimension with history (slowly changing dimension, type 2)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.keys import with_sequence

# End of an open version, and the weight difference that counts as a change.
OPEN_END = "9999-12-31 23:59:59"
OPEN_DAY = date(9999, 12, 31)
WEIGHT_TOLERANCE = 0.001
_COMPARED = ("product_name", "category", "barcode", "is_active")

DIMENSION_COLUMNS = [
    "product_sk",
    "product_id",
    "product_code",
    "product_name",
    "category",
    "barcode",
    "weight",
    "is_active",
    "effective_start_date",
    "effective_end_date",
    "is_current",
    "created_at",
    "row_digest",
    "end_day",
    "product_bucket",
]
#: Parts of the dimension, unless a load says otherwise.
BUCKETS = 16


def is_open() -> Column:
    return F.col("end_day") == F.lit(OPEN_DAY)


def product_bucket(product_id: Column, buckets: int = BUCKETS) -> Column:
    """The part of the dimension that all versions of a product lie in."""
    return F.pmod(F.xxhash64(product_id), F.lit(buckets)).cast("int")


def row_digest() -> Column:
    """A digest of the monitored columns; equal ones mean no change. Nulls have places of their own."""
    weight = F.col("weight").cast("double")
    monitored = [*[F.col(c) for c in _COMPARED], weight]
    return F.xxhash64(*[part for c in monitored for part in (c.isNull(), c)])


def product_rows(products: DataFrame, *more: str) -> DataFrame:
    return products.select(
        *more,
        F.col("product_id").cast("int").alias("product_id"),
        F.col("code").alias("product_code"),
        F.col("name").alias("product_name"),
        "category",
        "barcode",
        "weight",
        F.coalesce(F.col("is_active").cast("boolean"), F.lit(True)).alias("is_active"),
    )


def product_actions(dimension: DataFrame, products: DataFrame) -> DataFrame:
    """The product feed with what it does to the dimension: insert, change or keep.

    One left join of two sides that are unique by product. The product code is not monitored.
    """
    current = dimension.filter("is_current").select(
        "product_id",
        F.col("product_sk").alias("old_sk"),
        *[F.col(c).alias(f"_old_{c}") for c in (*_COMPARED, "weight")],
    )
    joined = product_rows(products).join(current, "product_id", "left")
    action = F.when(F.col("old_sk").isNull(), "insert").when(_has_changed(), "change").otherwise("keep")
    return joined.select(
        "product_id",
        "product_code",
        "product_name",
        "category",
        "barcode",
        F.col("weight").cast("decimal(10,2)").alias("weight"),
        "is_active",
        "old_sk",
        action.alias("action"),
    )


def possibly_changed(dimension: DataFrame, products: DataFrame) -> DataFrame:
    """The feed without the rows that have the digest of their product's open version: a join that reads two columns of the
    dimension. Rows are told apart, not products: of two rows of a product, one may change it."""
    current = dimension.filter("is_current").select(
        F.col("product_id").alias("_known"), F.col("row_digest").alias("_old_digest")
    )
    whole = products.withColumn("_row", F.struct(*(F.col(f"`{c}`") for c in products.columns)))
    digests = product_rows(whole, "_row").withColumn("_digest", row_digest())
    same = (F.col("product_id") == F.col("_known")) & (F.col("_digest") == F.col("_old_digest"))
    return digests.join(current, same, "left_anti").select("_row.*")


def product_changes(dimension: DataFrame, products: DataFrame) -> DataFrame:
    """The part of the feed that opens a version: what differs by digest, compared in detail."""
    return product_actions(dimension, possibly_changed(dimension, products)).filter("action <> 'keep'")


def apply_changes(
    dimension: DataFrame, changes: DataFrame, as_of: Column, buckets: int = BUCKETS, highest: Column | None = None
) -> DataFrame:
    """The dimension with superseded versions closed at `as_of` and new versions opened at it.

    `dimension` needs to hold the current versions of the products that change; closed ones pass through, and products that
    the feed does not name stay open. Keys continue after the highest current key (`highest`, or else that of
    `dimension`), which is the highest ever given: a closed version always has a later successor. `changes` is read three
    times, so a load stores it before (it is small beside the dimension). It may name a product more than once only where the
    load was told so: each row then opens a version, and what they supersede is a row for each of them, as in a join.
    """
    superseded = changes.filter("action = 'change'").select(
        F.col("old_sk").alias("product_sk"), F.lit(True).alias("_superseded")
    )
    closing = F.col("_superseded").isNotNull()
    history = dimension.join(superseded, "product_sk", "left").withColumns(
        {
            "effective_end_date": F.when(closing, as_of).otherwise(F.col("effective_end_date")),
            "is_current": F.when(closing, F.lit(False)).otherwise(F.col("is_current")),
        }
    )
    if highest is None:
        highest = dimension.agg(F.coalesce(F.max("product_sk"), F.lit(0).cast("bigint"))).scalar()
    versions = with_sequence(changes, "product_id", "product_sk", highest, ("product_code", *_COMPARED, "weight")).withColumns(
        {
            "effective_start_date": as_of,
            "effective_end_date": F.lit(OPEN_END).cast("timestamp_ntz"),
            "is_current": F.lit(True),
            "created_at": as_of,
        }
    )
    return _laid_out(history, buckets).unionByName(_laid_out(versions.withColumn("row_digest", row_digest()), buckets))


def product_scd2(dimension: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    """The dimension after a product feed, as one plan that evaluates the feed three times: for tests and small sets."""
    return apply_changes(dimension, product_changes(dimension, products), as_of)


def _laid_out(df: DataFrame, buckets: int) -> DataFrame:
    """Partition by the day a version ends (open versions lie together) and by the bucket of its product."""
    places = {"end_day": F.col("effective_end_date").cast("date"), "product_bucket": product_bucket(F.col("product_id"), buckets)}
    return df.withColumns(places).select(*DIMENSION_COLUMNS)


def _has_changed() -> Column:
    changed = _weight_changed()
    for name in _COMPARED:
        changed = changed | ~F.col(name).eqNullSafe(F.col(f"_old_{name}"))
    return changed


def _weight_changed() -> Column:
    """A weight that appears where there was none is no change; one that disappears is."""
    new, old = F.col("weight").cast("double"), F.col("_old_weight").cast("double")
    moved = F.coalesce(F.abs(old - new) > WEIGHT_TOLERANCE, F.lit(False))
    return F.when(new.isNotNull(), moved).otherwise(old.isNotNull())
