from __future__ import annotations

from datetime import date

import pytest

from shelfline.operators import quality

DAY = date(2026, 6, 1)


@pytest.mark.parametrize(
    ("rows", "expected"),
    [([(1, "A"), (2, "B"), (3, "C")], (True, 0)), ([(1, "A"), (None, "B"), (3, None)], (False, 2))],
)
def test_null_check(spark, rows, expected):
    assert quality.run_null_check(spark.createDataFrame(rows, "id INT, name STRING"), ["id", "name"]) == expected


def test_null_check_skips_an_absent_column(spark):
    df = spark.createDataFrame([(1,), (None,)], "id INT")
    assert quality.run_null_check(df, ["id", "nowhere"]) == (False, 1)
    assert quality.run_null_check(df, ["nowhere"]) == (True, 0)


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x DOUBLE")
    assert quality.run_null_check(df, ["x"]) == (False, 2)


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([(DAY, 1), (DAY, 2)], (True, 0)),
        ([(DAY, 1), (DAY, 1)], (False, 2)),
        ([(DAY, None), (DAY, None), (DAY, None), (DAY, 1)], (False, 3)),
        ([], (True, 0)),
    ],
)
def test_duplicate_check(spark, rows, expected):
    df = spark.createDataFrame(rows, "inventory_date DATE, product_id INT")
    assert quality.run_duplicate_check(df, ["inventory_date", "product_id"]) == expected


def test_duplicate_check_fails_on_an_absent_key(spark):
    df = spark.createDataFrame([(1,), (2,)], "a INT")
    assert quality.run_duplicate_check(df, ["a", "b"]) == (False, 2)


@pytest.mark.parametrize(("rows", "violations"), [([(10, 5), (20, 15)], 0), ([(-5, 5), (20, -15)], 2)])
def test_business_check_only_warns(spark, rows, violations):
    df = spark.createDataFrame(rows, "stock_awal BIGINT, stock_akhir BIGINT")
    assert quality.run_inventory_business_validation(df) == (True, violations)
    assert quality.run_inventory_business_validation(df.select("stock_awal"))[1] in (0, 1)
    assert quality.run_inventory_business_validation(df.selectExpr("1 AS other")) == (True, 0)


def test_all_rules_in_one_scan_equal_the_single_checks(spark):
    rows = [(DAY, 1, -1, 2), (DAY, 1, 3, -4), (DAY, None, None, 5), (None, 2, -7, None)]
    df = spark.createDataFrame(rows, "inventory_date DATE, product_id INT, stock_awal BIGINT, stock_akhir BIGINT")
    passed, counts = quality.check_mart(df, quality.DAILY_RULES)
    assert not passed
    assert counts == {
        "row_count": 4,
        "nulls": quality.run_null_check(df, quality.DAILY_RULES.not_null)[1],
        "duplicates": quality.run_duplicate_check(df, quality.DAILY_RULES.key)[1],
        "biz_warnings": quality.run_inventory_business_validation(df)[1],
    }
    assert counts["nulls"] == 4 and counts["duplicates"] == 2 and counts["biz_warnings"] == 3


def test_check_of_an_empty_mart_passes(spark):
    df = spark.createDataFrame([], "inventory_date DATE, product_id INT, stock_awal BIGINT, stock_akhir BIGINT")
    assert quality.check_mart(df, quality.DAILY_RULES) == (
        True,
        {"row_count": 0, "nulls": 0, "duplicates": 0, "biz_warnings": 0},
    )


def test_check_of_a_mart_without_its_key_fails(spark):
    df = spark.createDataFrame([(DAY, 1, 1)], "inventory_date DATE, stock_awal BIGINT, stock_akhir BIGINT")
    passed, counts = quality.check_mart(df, quality.DAILY_RULES)
    assert not passed and counts["duplicates"] == 1


def test_require_unique(spark):
    df = spark.createDataFrame([(1,), (1,)], "k INT")
    with pytest.raises(quality.DataQualityError):
        quality.require_unique(df, ["k"])
