"""Surrogate keys that need neither a driver loop nor a window over the whole set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Code of each movement type inside a movement key.
MOVEMENT_TYPE_CODES = {"INBOUND": 0, "OUTBOUND": 1, "ADJUSTMENT": 2}

# Rows of the sequence are numbered inside ranges of 2^16 ids, so a 32-bit id has at most 2^16 ranges.
_RANGE_BITS = 16


def movement_key(movement_type: Column, reference: Column) -> Column:
    """Unique, stable key of a movement: a pure function of its natural key, so an upsert keeps it."""
    code = F.lit(None).cast("bigint")
    for name, number in MOVEMENT_TYPE_CODES.items():
        code = F.when(movement_type == name, F.lit(number)).otherwise(code)
    return reference.cast("bigint") * 4 + code


def daily_key(day: Column, product_id: Column) -> Column:
    """Unique, stable key of a (day, product) row: the day number above 32 bits of product id."""
    return F.shiftleft(F.unix_date(day).cast("bigint"), 32) + product_id.cast("bigint")


def with_sequence(df: DataFrame, id_column: str, key_column: str, start: Column, then: Sequence[str] = ()) -> DataFrame:
    """Add keys start+1, start+2, ... in the order of an INT column; a NULL id gets one as well.

    Where ids repeat, the columns of `then` decide. Each id range is numbered on its own and shifted by the row counts of the ranges
    before it. A range holds at most 2^16 distinct ids and there are at most 2^16 ranges, which bounds both windows and makes
    the offset table safe to broadcast. Every value depends on the data only, never on how it happened to
    be partitioned, so a task that runs twice gives the same keys.
    """
    ranged = df.withColumn("_range", F.shiftright(F.col(id_column), _RANGE_BITS))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(id_column, *then))
    shifts = F.broadcast(offsets.withColumnRenamed("_range", "_of"))
    return (
        ranged.join(shifts, F.col("_range").eqNullSafe(F.col("_of")))
        .withColumn(key_column, start + F.col("_offset") + inside)
        .drop("_range", "_of", "_offset")
    )
