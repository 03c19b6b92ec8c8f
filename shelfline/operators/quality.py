"""Null, duplicate and business checks, and the rules that gate each mart."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.numeric import missing

logger = logging.getLogger(__name__)


class DataQualityError(ValueError):
    """A critical check failed; nothing after it runs."""


@dataclass(frozen=True)
class MartRules:
    not_null: tuple[str, ...]
    key: tuple[str, ...] = ()
    not_negative: tuple[str, ...] = ()


# The columns each mart is checked on.
NOT_NEGATIVE = ("stock_awal", "stock_akhir")
DAILY_RULES = MartRules(
    not_null=("inventory_date", "product_id", "stock_awal", "stock_akhir"),
    key=("inventory_date", "product_id"),
    not_negative=NOT_NEGATIVE,
)
MOVEMENT_RULES = MartRules(
    not_null=("movement_date", "product_id", "movement_type", "quantity", "source_reference_id"),
    key=("movement_type", "source_reference_id"),
)
REORDER_RULES = MartRules(not_null=("inventory_date", "product_id", "stock_akhir", "recommended_reorder_qty"))


def null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of nulls, counted in one pass. Absent columns are left out."""
    present = _present(df, columns)
    if not present:
        return df.sparkSession.createDataFrame([], "column_name string, null_count bigint")
    counts = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in present])
    return counts.unpivot([], present, "column_name", "null_count")


def duplicate_report(df: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """One row: all rows, and the rows whose key occurs more than once. NULL keys equal each other.

    Keys are counted inside each task before they are shuffled, so a key that holds most rows travels as
    one count per task.
    """
    per_key = _key_groups(df, key_columns).agg(F.count(F.lit(1)).alias("_rows"))
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"), _repeated("_rows").alias("duplicate_count")
    )


def business_report(df: DataFrame, columns: Sequence[str] = NOT_NEGATIVE) -> DataFrame:
    """One row per present column with its number of negative values."""
    present = _present(df, columns)
    if not present:
        return df.sparkSession.createDataFrame([], "column_name string, negative_count bigint")
    counts = df.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in present])
    return counts.unpivot([], present, "column_name", "negative_count")


def run_null_check(df: DataFrame, columns_to_check: Sequence[str]) -> tuple[bool, int]:
    """(passed, nulls over all columns). A column that does not exist is skipped with a warning."""
    for name in set(columns_to_check) - set(df.columns):
        logger.warning("null check skips absent column %s", name)
    nulls = _total(null_report(df, columns_to_check), "null_count")
    return nulls == 0, nulls


def run_duplicate_check(df: DataFrame, key_columns: Sequence[str]) -> tuple[bool, int]:
    """(passed, rows in duplicated groups). An absent key column fails the check for every row."""
    if set(key_columns) - set(df.columns):
        logger.error("duplicate check misses key columns %s", sorted(set(key_columns) - set(df.columns)))
        return False, df.count()
    duplicates = _total(duplicate_report(df, key_columns), "duplicate_count")
    return duplicates == 0, duplicates


def run_inventory_business_validation(df: DataFrame) -> tuple[bool, int]:
    """(True, negative opening and closing stocks): a warning, never a failure."""
    violations = _total(business_report(df), "negative_count")
    if violations:
        logger.warning("%d negative stock figures", violations)
    return True, violations


def rule_report(df: DataFrame, rules: MartRules) -> DataFrame:
    """One row (row_count, nulls, duplicates, biz_warnings): every rule of a mart in one scan."""
    none = F.lit(0).cast("bigint")
    flags = {
        "_nulls": [missing(df, c) for c in _present(df, rules.not_null)],
        "_negatives": [F.coalesce(F.col(c) < 0, F.lit(False)) for c in _present(df, rules.not_negative)],
    }
    # A rule without columns adds nothing to what is shuffled per key.
    counted = [F.sum(_sum_of_flags(tests)).alias(name) for name, tests in flags.items() if tests]
    per_key = _key_groups(df, rules.key) if rules.key else df.groupBy()
    grouped = per_key.agg(F.count(F.lit(1)).alias("_rows"), *counted)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), none) if name in grouped.columns else none

    return grouped.agg(
        total("_rows").alias("row_count"),
        total("_nulls").alias("nulls"),
        (_repeated("_rows") if rules.key else none).alias("duplicates"),
        total("_negatives").alias("biz_warnings"),
    )


def measures(df: DataFrame, rules: MartRules) -> dict[str, Column]:
    """What can be counted of a mart's rules while it is written: all but duplicates."""
    nulls = [missing(df, c) for c in _present(df, rules.not_null)]
    negatives = [F.coalesce(F.col(c) < 0, F.lit(False)) for c in _present(df, rules.not_negative)]
    none = F.lit(0).cast("bigint")
    return {
        name: F.coalesce(F.sum(_sum_of_flags(flags)), none) for name, flags in (("nulls", nulls), ("biz_warnings", negatives))
    }


def check_mart(df: DataFrame, rules: MartRules) -> tuple[bool, dict[str, int]]:
    """(critical checks passed, counts). Nulls and duplicates are critical, negative stock is a warning."""
    for name in set(rules.not_null) - set(df.columns):
        logger.warning("null check skips absent column %s", name)
    if set(rules.key) - set(df.columns):
        _, nulls = run_null_check(df, rules.not_null)
        _, duplicates = run_duplicate_check(df, rules.key)
        return False, {"row_count": duplicates, "nulls": nulls, "duplicates": duplicates, "biz_warnings": 0}
    counts = rule_report(df, rules).first().asDict()
    return counts["nulls"] == 0 and counts["duplicates"] == 0, counts


def require_unique(df: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """The set itself, once every row has a key and no key occurs twice: a merge would lose or multiply such rows."""
    unique_rows(df, key_columns)
    return df


def require_keys(df: DataFrame, key_columns: Sequence[str]) -> None:
    """Every row has a key; keys may repeat."""
    keys = tuple(key_columns)
    if nulls := rule_report(df, MartRules(not_null=keys)).first()["nulls"]:
        raise DataQualityError(f"{nulls} nulls in key {keys}")


def unique_rows(df: DataFrame, key_columns: Sequence[str]) -> int:
    """The rows of a set, counted by the check that every row has a key and no key occurs twice."""
    keys = tuple(key_columns)
    if set(keys) - set(df.columns):
        raise DataQualityError(f"key columns {sorted(set(keys) - set(df.columns))} are absent")
    found = rule_report(df, MartRules(not_null=keys, key=keys)).first()
    if found["nulls"]:
        raise DataQualityError(f"{found['nulls']} nulls in key {keys}")
    if found["duplicates"]:
        raise DataQualityError(f"{found['duplicates']} rows share a key {keys}")
    return found["row_count"]


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def _key_groups(df: DataFrame, key_columns: Sequence[str]):
    return df.groupBy(*[F.when(~missing(df, c), F.col(c)).alias(c) for c in key_columns])


def _repeated(rows: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col(rows) > 1, F.col(rows))), F.lit(0))


def _sum_of_flags(flags: list[Column]) -> Column:
    total = F.lit(0).cast("bigint")
    for flag in flags:
        total = total + flag.cast("bigint")
    return total


def _total(report: DataFrame, column: str) -> int:
    return report.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0]
