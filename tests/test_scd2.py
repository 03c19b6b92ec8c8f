from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from shelfline import schemas
from shelfline.operators import scd2

T1, T2, T3 = (datetime(2026, 6, d, 6) for d in (1, 2, 3))
OPEN = datetime(9999, 12, 31, 23, 59, 59)


def at(moment):
    return F.lit(moment).cast("timestamp_ntz")


def feed(spark, *rows):
    schema = "product_id INT, code STRING, name STRING, category STRING, barcode STRING, weight DOUBLE, is_active BOOLEAN"
    return spark.createDataFrame(list(rows), schema)


def product(key, name="Item", category="C", barcode="B", weight=1.0, active=True, code="P"):
    return (key, code, name, category, barcode, weight, active)


def empty(spark):
    return spark.createDataFrame([], schemas.WAREHOUSE["dim_product"])


def loaded(spark, *feeds):
    dimension = empty(spark)
    for moment, rows in zip((T1, T2, T3), feeds):
        after = scd2.product_scd2(dimension, feed(spark, *rows), at(moment))
        dimension = spark.createDataFrame(after.collect(), after.schema)
    return dimension


def test_new_products_open_a_version(spark):
    rows = loaded(spark, [product(2), product(1)]).orderBy("product_id").collect()
    assert [(r["product_sk"], r["product_id"], r["is_current"]) for r in rows] == [(1, 1, True), (2, 2, True)]
    assert {(r["effective_start_date"], r["effective_end_date"]) for r in rows} == {(T1, OPEN)}


def test_a_change_closes_the_old_version_where_the_new_one_starts(spark):
    rows = loaded(spark, [product(1), product(2)], [product(1, category="D"), product(2)]).orderBy("product_sk").collect()
    assert [(r["product_sk"], r["product_id"], r["category"], r["is_current"]) for r in rows] == [
        (1, 1, "C", False),
        (2, 2, "C", True),
        (3, 1, "D", True),
    ]
    assert rows[0]["effective_end_date"] == rows[2]["effective_start_date"] == T2


@pytest.mark.parametrize(
    ("old", "new", "changed"),
    [
        (None, None, False),
        (None, 1.0, False),
        (1.0, None, True),
        (1.0, 1.0, False),
        (1.0, 1.0005, False),
        (1.0, 1.01, True),
    ],
)
def test_weight_rule(spark, old, new, changed):
    before = loaded(spark, [product(1, weight=old)])
    action = scd2.product_actions(before, feed(spark, product(1, weight=new))).first()["action"]
    assert action == ("change" if changed else "keep")


@pytest.mark.parametrize(
    ("field", "old", "new", "changed"),
    [
        ("name", "a", "b", True),
        ("category", None, "C", True),
        ("category", "C", None, True),
        ("category", None, None, False),
        ("barcode", "x", "y", True),
        ("active", True, False, True),
        ("active", True, None, False),
        ("code", "P1", "P2", False),
    ],
)
def test_monitored_columns(spark, field, old, new, changed):
    before = loaded(spark, [product(1, **{field: old})])
    action = scd2.product_actions(before, feed(spark, product(1, **{field: new}))).first()["action"]
    assert action == ("change" if changed else "keep")


def test_absent_products_stay_open(spark):
    rows = loaded(spark, [product(1), product(2)], [product(1)]).collect()
    assert len(rows) == 2 and all(r["is_current"] for r in rows)


def test_history_invariants_over_several_loads(spark):
    loads = [
        [product(k, weight=float(k)) for k in range(1, 40)],
        [product(k, weight=float(k + (k % 3 == 0))) for k in range(5, 60)],
        [product(k, name="Item" if k % 4 else "Thing", weight=float(k + (k % 3 == 0))) for k in range(1, 60)],
    ]
    dimension = loaded(spark, *loads)
    per_product = dimension.groupBy("product_id").agg(F.count_if("is_current").alias("n"))
    assert per_product.filter("n <> 1").count() == 0
    assert dimension.count() == dimension.select("product_sk").distinct().count()
    order = Window.partitionBy("product_id").orderBy("effective_start_date")
    gaps = dimension.withColumn("next", F.lead("effective_start_date").over(order)).filter(
        "coalesce(next, timestamp_ntz'9999-12-31 23:59:59') <> effective_end_date"
    )
    assert gaps.count() == 0
    again = scd2.product_scd2(dimension, feed(spark, *loads[-1]), at(datetime(2026, 6, 4)))
    assert again.count() == dimension.count()
    assert dimension.filter("weight IS NULL").count() == 0
    assert dimension.filter("product_id = 9 AND is_current").first()["weight"] == Decimal("10.00")


def test_a_sequence_gives_every_row_a_key(spark):
    from shelfline.functions.keys import with_sequence

    rows = spark.createDataFrame([(None,), (70_000,), (3,), (1,)], "id INT")
    keyed = with_sequence(rows, "id", "sk", F.lit(10).cast("bigint")).collect()
    assert sorted(r["sk"] for r in keyed) == [11, 12, 13, 14]


def test_the_unchanged_row_of_a_product_does_not_hide_its_changed_one(spark):
    before = loaded(spark, [product(1), product(2)])
    twice = feed(spark, product(1), product(1, category="D"), product(2))
    changes = scd2.product_changes(before, twice).collect()
    assert [(r["product_id"], r["category"], r["action"]) for r in changes] == [(1, "D", "change")]


@pytest.mark.parametrize("rows", [[product(1, name="a"), product(1, name="b")], [product(3), product(3)], [product(None)]])
def test_rows_that_open_two_versions_of_a_product_are_refused(spark, tmp_path, rows):
    from shelfline.config import EngineConfig
    from shelfline.operators.quality import DataQualityError
    from shelfline.plans import warehouse
    from shelfline.sinks.tables import write_set
    from shelfline.sources.files import conform

    for moment, loads, refused in ((T1, [product(1), product(2)], False), (T2, [product(2), *rows], True)):
        config = EngineConfig.under(tmp_path.as_uri(), moment)
        raw = feed(spark, *loads).withColumn("created_at", at(T1))
        write_set(conform(raw, schemas.RAW["products"]), f"{config.raw_dir}/products")
        if refused:
            with pytest.raises(DataQualityError):
                warehouse.load_products_scd2(spark, config)
        else:
            assert warehouse.load_products_scd2(spark, config) == 2
    assert warehouse.read_table(spark, config, "dim_product").count() == 2


def test_new_ids_that_are_known_already_give_the_rows_of_the_sql(spark, tmp_path):
    """Above a million products, the ids that the later feed adds are those of products that it holds as well."""
    import duckdb

    from registered.oracles import ORACLES
    from registered.queries import QUERIES
    from tests import parity

    source = "SELECT * REPLACE (p_partkey + 1000000 * k AS p_partkey) FROM '/root/testdata/sf0.001/part.parquet', range(2) AS r(k)"
    duckdb.sql(f"COPY (SELECT * EXCLUDE (k) FROM ({source})) TO '{tmp_path}/part.parquet' (FORMAT parquet)")
    result = QUERIES["product_scd2"](spark, str(tmp_path))
    assert parity.differences(result, parity.oracle_connection(str(tmp_path)), ORACLES["product_scd2"]) == []


def test_two_new_versions_of_a_known_id_give_the_rows_of_the_sql(spark, tmp_path):
    """The same where the products a million ids apart are different ones, so that both rows of an id open a version."""
    import duckdb

    from registered.oracles import ORACLES
    from registered.queries import QUERIES
    from tests import parity

    part = "SELECT 1000000 * k + i AS p_partkey, 'name ' || i || k AS p_name, 'b' || k AS p_brand, 't' AS p_type, 5 + k AS p_size, 1.0 AS p_retailprice"
    source = f"{part} FROM range(400) AS a(i), range(2) AS r(k)"
    duckdb.sql(f"COPY (SELECT p_partkey::BIGINT AS p_partkey, p_name, p_brand, p_type, p_size::INT AS p_size, p_retailprice::DOUBLE AS p_retailprice FROM ({source})) TO '{tmp_path}/part.parquet' (FORMAT parquet)")
    result = QUERIES["product_scd2"](spark, str(tmp_path))
    connection, sql = parity.oracle_connection(str(tmp_path)), ORACLES["product_scd2"]
    twice = result.filter("is_current").groupBy("product_id").count().filter("count > 1")
    assert twice.count() > 5
    # Which of two new versions has the lesser key is open in the SQL; the keys of an id are the same.
    assert parity.differences(result.drop("product_sk"), connection, f"SELECT * EXCLUDE (product_sk) FROM ({sql}) AS x") == []
    keys = "product_sk, product_id, is_current"
    assert parity.differences(result.selectExpr(*keys.split(", ")), connection, f"SELECT {keys} FROM ({sql}) AS x") == []


def test_a_load_that_may_open_several_versions_still_refuses_rows_without_a_product(spark, tmp_path):
    from shelfline.config import EngineConfig
    from shelfline.operators.quality import DataQualityError
    from shelfline.plans import warehouse
    from shelfline.sinks.tables import write_set
    from shelfline.sources.files import conform

    config = EngineConfig.under(tmp_path.as_uri(), T1)
    write_set(conform(feed(spark, product(1), product(None)).withColumn("created_at", at(T1)), schemas.RAW["products"]), f"{config.raw_dir}/products")
    with pytest.raises(DataQualityError):
        warehouse.load_products_scd2(spark, config, several=True)
