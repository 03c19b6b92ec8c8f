"""The physical plans that the design rests on."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from registered.queries import QUERIES
from shelfline import schemas
from shelfline.operators import merge
from shelfline.operators.movements import outbound
from shelfline.sinks import versions
from shelfline.sinks.tables import touched_partitions, touched_ranges, write_set
from shelfline.sources.feeds import incremental_purchases
from tests.conftest import SF_DIR


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def count(text: str, operator: str) -> int:
    return len(re.findall(rf"(?:\+-|:-|^)\s*(?:\*\(\d+\) )?{operator}\b", text, flags=re.M))


def test_the_whole_chain_shuffles_twice_and_joins_nothing(spark):
    text = plan(QUERIES["reorder_analysis_wide"](spark, SF_DIR))
    assert count(text, "Exchange hashpartitioning") == 2
    assert "Join" not in text and "Python" not in text
    assert count(text, "Sort") == 1
    assert count(text, "Window") == 2


def test_sums_are_combined_before_the_first_shuffle(spark):
    text = plan(QUERIES["inventory_snapshot"](spark, SF_DIR))
    assert re.search(r"Exchange hashpartitioning\(product_id#\d+, inventory_date#\d+.*\n.*HashAggregate.*partial_sum", text)


def test_scans_read_the_columns_they_need(spark):
    text = formatted(spark, QUERIES["inventory_snapshot_wide"](spark, SF_DIR))
    schemas_read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert len(schemas_read) == 4
    assert all("l_extendedprice" not in s and "l_orderkey" not in s for s in schemas_read)


def test_the_watermark_reaches_the_scan(spark):
    text = formatted(spark, QUERIES["incremental_stock_daily"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in text


def test_movements_need_no_shuffle(spark):
    feed = spark.createDataFrame([], schemas.RAW["sales"])
    assert "Exchange" not in plan(outbound(feed))


def test_an_upsert_reads_only_the_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = spark.range(1000).select(
        F.date_add(F.lit(date(2026, 1, 1)), (F.col("id") % 20).cast("int")).alias("d"), F.col("id").alias("k"), F.lit(1).alias("v")
    )
    assert write_set(rows, path, ["d"], ["k"]) == 1000
    table = spark.read.schema("d DATE, k BIGINT, v INT").parquet(path)
    feed = rows.filter(F.col("d") == F.lit(date(2026, 1, 3))).withColumn("v", F.lit(2))
    pruned = touched_partitions(table, feed, ["d"])
    assert pruned.count() == 50
    assert re.search(r"PartitionFilters: \[[^\]]*d#\d+", plan(pruned))
    merged = merge.merge_upsert(pruned, feed, ["d", "k"])
    assert merged.filter("v = 2").count() == merged.count() == 50


def test_pruning_has_one_form_at_every_size(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("kind"), (F.col("id") % 300).alias("p"), F.col("id").alias("k")
    )
    write_set(rows, path, ["kind", "p"], ["k"])
    table = spark.read.schema("kind STRING, p BIGINT, k BIGINT").parquet(path)
    for wanted, count in (("p IN (4, 8)", 40), ("p < 200", 4000), ("p = 4 OR (kind = 'b' AND p > 280)", 220), ("p < 0", 0)):
        touched = touched_partitions(table, rows.filter(wanted), ["kind", "p"])
        assert touched.count() == count
        assert "PartitionFilters: [false]" in plan(touched) or re.search(r"PartitionFilters: \[[^\]]*p#\d+", plan(touched)) or not count
        assert "SemiJoin" in plan(touched) or "LeftSemi" in plan(touched) or not count


def test_a_late_row_makes_a_range_of_its_own(spark, tmp_path):
    """Today's references and one of three years ago: only their buckets are read, not what lies between."""
    path = str(tmp_path / "t")
    rows = spark.range(0, 1000).select((F.col("id") % 2).alias("kind"), F.floor(F.col("id") / 2).alias("p"), F.col("id").alias("k"))
    rows.write.partitionBy("kind", "p").parquet(path)
    table = spark.read.schema("k BIGINT, kind BIGINT, p BIGINT").parquet(path)
    feed = spark.createDataFrame([(0, 3), (0, 496), (0, 498), (0, 499), (1, 499)], "kind BIGINT, p BIGINT")
    spans = sorted((r["kind"], r["_low"], r["_high"]) for r in touched_ranges(feed, ["kind", "p"], 3))
    assert spans == [(0, 3, 3), (0, 496, 496), (0, 498, 499), (1, 499, 499)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        touched = touched_partitions(table, feed, ["kind", "p"], 3)
        assert sorted(r["k"] for r in touched.collect()) == [6, 992, 996, 998, 999]
        leaves = touched._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size()) if "FileScan" in leaves.apply(i).toString()]
        assert [s.metrics().get("numFiles").get().value() for s in scans] == [5]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("most", [1, 2, 3, 100])
def test_the_number_of_ranges_does_not_change_the_rows(spark, tmp_path, most):
    path = str(tmp_path / "t")
    days = [date(2026, 1, d) for d in (1, 2, 5, 9, 20, 31)]
    spark.createDataFrame([(d, i) for i, d in enumerate(days)], "d DATE, k INT").write.partitionBy("d").parquet(path)
    table = spark.read.schema("k INT, d DATE").parquet(path)
    feed = spark.createDataFrame([(days[0],), (days[1],), (days[3],), (days[5],), (date(2027, 1, 1),)], "d DATE")
    assert len(touched_ranges(feed, ["d"], most)) == min(most, 4)
    assert sorted(r["k"] for r in touched_partitions(table, feed, ["d"], most).collect()) == [0, 1, 3, 5]
    assert touched_ranges(feed.limit(0), ["d"], most) == []
    assert touched_partitions(table, feed.limit(0), ["d"], most).count() == 0


def test_an_upsert_evaluates_each_side_once(spark, tmp_path):
    feed, target = (spark.range(50).select("id", F.rand(s).alias("v")) for s in (1, 2))
    text = plan(merge.merge_upsert(target, feed, ["id"]))
    assert text.count("Range (") == 2 * text.count("== Physical Plan ==") or text.count("Range (") <= 4


def above(text: str, leaf: str) -> list[str]:
    """The operators on the way from the root of a printed plan to its first line that names `leaf`."""
    path: list[tuple[int, str]] = []
    for line in text.splitlines():
        depth = len(re.match(r"[\s:|+-]*", line)[0])
        path = [p for p in path if p[0] < depth] + [(depth, line.strip(" :+-"))]
        if leaf in line:
            return [p[1] for p in path]
    raise AssertionError(f"no {leaf} in the plan")


def stored_table(spark, folder, buckets=4, rows=4000):
    schema = "k BIGINT, v INT, b INT"
    table = spark.range(rows).selectExpr("id k", "0 v", f"cast(id % {buckets} as int) b")
    base = versions.replace_partitions(table, versions.current(spark, folder), ["b"], ["k"])
    return base, schema


def test_a_small_feed_leaves_the_target_where_it_is(spark, tmp_path):
    base, schema = stored_table(spark, str(tmp_path / "target"))
    write_set(spark.range(0, 4000, 400).selectExpr("id k", "1 v", "cast(id % 4 as int) b"), str(tmp_path / "feed"))
    feed = spark.read.schema(schema).parquet(str(tmp_path / "feed"))
    target = versions.read(spark, base, schema)
    merged, in_place = merge.merge_in_place(target, feed, ["k"], 10, ["b"])
    path = above(plan(merged.sortWithinPartitions("b", "k")), "FileScan")
    assert in_place and any("LeftAnti" in step for step in path)
    assert not [step for step in path if "Exchange" in step]
    outer, in_place = merge.merge_in_place(target, feed, ["k"], 10, ["b"], most=9)
    assert not in_place and sorted(map(tuple, outer.collect())) == sorted(map(tuple, merged.collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [step for step in above(plan(merge.merge_upsert(target, feed, ["k"])), "FileScan") if "Exchange" in step]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_files_do_not_grow_in_number_from_merge_to_merge(spark, tmp_path):
    base, schema = stored_table(spark, str(tmp_path / "target"))
    files = []
    for load in range(1, 7):
        write_set(spark.range(load, 4000, 500).selectExpr("id k", f"{load} v", "cast(id % 4 as int) b"), str(tmp_path / "feed"))
        feed = spark.read.schema(schema).parquet(str(tmp_path / "feed"))
        target = versions.read(spark, versions.touched(base, feed, ["b"]), schema)
        merged, _ = merge.merge_in_place(target, feed, ["k"], 8, ["b"])
        base = versions.replace_partitions(merged, base, ["b"], ["k"], rebalance=False)
        files.append(len(list((tmp_path / "target").glob(f"{max(base.parts.values())}/b=*/*.parquet"))))
    assert max(files[2:]) <= max(files[:2]) + 2 * 4, files
    rows = versions.read(spark, base, schema)
    assert (rows.count(), rows.filter("v > 0").count()) == (4000, 48)


def test_a_large_partition_is_split_while_small_ones_are_merged(spark, tmp_path):
    """Two thirds of the rows fall on one day; its files are bounded, the other days share tasks."""
    path = str(tmp_path / "hot")
    day = F.when(F.col("id") % 3 == 0, F.col("id") % 30).otherwise(F.lit(7)).cast("int")
    rows = spark.range(300_000).select(F.date_add(F.lit(date(2026, 1, 1)), day).alias("d"), F.xxhash64("id").alias("k"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512KB")
    try:
        assert write_set(rows, path, ["d"], ["k"]) == 300_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "hot").glob("d=*")}
    assert files["d=2026-01-08"] >= 4
    assert all(count == 1 for name, count in files.items() if name != "d=2026-01-08")
    assert spark.read.schema("d DATE, k BIGINT").parquet(path).count() == 300_000


def test_an_order_with_a_third_of_all_lines_is_split(spark):
    """Thresholds are lowered to the size of the test; the shuffled join splits the hot order."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    order = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000)
    detail = spark.range(0, 300_000, 1, 16).select(
        F.col("id").alias("po_detail_id"),
        order.cast("bigint").alias("po_header_id"),
        (F.col("id") % 97).cast("int").alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(1).cast("decimal(12,2)").alias("unit_price"),
        F.lit(1).alias("received_quantity"),
        F.lit("2026-01-02 00:00:00").cast("timestamp_ntz").alias("received_date"),
    )
    header = spark.range(5000).select(
        F.col("id").alias("po_header_id"),
        F.concat(F.lit("PO-"), F.col("id").cast("string")).alias("po_number"),
        F.lit(1).alias("supplier_id"),
        F.lit(date(2026, 1, 1)).alias("order_date"),
    )
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = incremental_purchases(detail, header, date(2026, 1, 1))
        assert len(joined.collect()) == 300_000
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
