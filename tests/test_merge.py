from __future__ import annotations

from datetime import date, datetime

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.functions.keys import daily_key, movement_key, with_sequence
from shelfline.operators import merge

T1, T2 = datetime(2026, 6, 1, 6), datetime(2026, 6, 2, 6)


def at(moment):
    return F.lit(moment).cast("timestamp_ntz")


keyed = st.dictionaries(st.integers(0, 12), st.integers(0, 5), max_size=10)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=keyed, feed=keyed)
def test_upsert_is_a_dictionary_update_and_idempotent(spark, target, feed):
    schema = "k INT, v INT"
    old = spark.createDataFrame(list(target.items()), schema)
    new = spark.createDataFrame(list(feed.items()), schema)
    once = merge.merge_upsert(old, new, ["k"])
    assert dict(map(tuple, once.collect())) == {**target, **feed}
    twice = merge.merge_upsert(once, new, ["k"])
    assert sorted(map(tuple, twice.collect())) == sorted({**target, **feed}.items())


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=keyed, feed=keyed, most=st.sampled_from([0, 100]))
def test_a_merge_in_place_has_the_rows_of_the_outer_join(spark, target, feed, most):
    schema = "k INT, v INT, born INT"
    old = spark.createDataFrame([(k, v, None if v == 0 else v) for k, v in target.items()], schema)
    new = spark.createDataFrame([(k, v, -1) for k, v in feed.items()], schema)
    merged, in_place = merge.merge_in_place(old, new, ["k"], len(feed), keep_on_conflict=["born"], most=most)
    assert in_place == (len(feed) <= most)
    expected = {k: (v, None if v == 0 else v) for k, v in target.items()}
    expected |= {k: (v, expected[k][1] if k in expected else -1) for k, v in feed.items()}
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted(((k, *x) for k, x in expected.items()), key=repr)


def test_supplier_keeps_its_creation_time(spark):
    feed = spark.createDataFrame(
        [(1, "S1", "New name", None, "ID", T2), (2, "S2", "Second", "b@x", None, T2)], schemas.RAW["suppliers"]
    )
    target = spark.createDataFrame(
        [(1, "S1", "Old name", "a@x", "ID", T1, T1), (3, "S3", "Third", None, None, None, T1)],
        schemas.WAREHOUSE["dim_supplier"],
    )
    rows = {r["supplier_id"]: r for r in merge.supplier_upsert(target, feed, at(T2)).collect()}
    assert len(rows) == 3
    assert (rows[1]["supplier_name"], rows[1]["email"], rows[1]["created_at"]) == ("New name", None, T1)
    assert (rows[2]["created_at"], rows[2]["ingestion_date"]) == (T2, T2)
    assert rows[3]["ingestion_date"] == T1


def test_conflict_keeps_a_null_of_the_target(spark):
    feed = spark.createDataFrame([(3, "S3", "Third", None, None, T2)], schemas.RAW["suppliers"])
    target = spark.createDataFrame([(3, "S3", "Third", None, None, None, T1)], schemas.WAREHOUSE["dim_supplier"])
    assert merge.supplier_upsert(target, feed, at(T2)).first()["created_at"] is None


def test_keys_are_functions_of_the_natural_key(spark):
    df = spark.createDataFrame([("INBOUND", 7), ("OUTBOUND", 7), ("ADJUSTMENT", 7), ("INBOUND", 8)], "t STRING, r BIGINT")
    assert [r[0] for r in df.select(movement_key(F.col("t"), F.col("r"))).collect()] == [28, 29, 30, 32]
    days = spark.createDataFrame([(date(1970, 1, 2), 5), (date(2026, 6, 1), 2**31 - 1)], "d DATE, p INT")
    first, second = [r[0] for r in days.select(daily_key(F.col("d"), F.col("p"))).collect()]
    assert first == 2**32 + 5
    assert second == (date(2026, 6, 1) - date(1970, 1, 1)).days * 2**32 + 2**31 - 1


def test_sequence_is_dense_and_ordered_across_ranges(spark):
    ids = [-5, 0, 1, 65_535, 65_536, 70_000, 2**31 - 1, 131_072, -(2**31)]
    df = spark.createDataFrame([(i,) for i in ids], "id INT").repartition(5)
    numbered = with_sequence(df, "id", "sk", F.lit(100).cast("bigint")).orderBy("id").collect()
    assert [(r["id"], r["sk"]) for r in numbered] == list(zip(sorted(ids), range(101, 101 + len(ids))))


def test_sequence_of_many_ids(spark):
    df = spark.range(0, 600_000, 3).select(F.col("id").cast("int").alias("id"))
    stats = with_sequence(df, "id", "sk", F.lit(0)).agg(
        F.min("sk"), F.max("sk"), F.countDistinct("sk"), F.count_if(F.col("sk") != F.col("id") / 3 + 1)
    )
    assert tuple(stats.first()) == (1, 200_000, 200_000, 0)
