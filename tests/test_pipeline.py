"""The four stages on stored layers: idempotence, history, gates, audit and recovery."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.config import EngineConfig
from shelfline.operators.quality import DataQualityError
from shelfline.plans import pipeline, warehouse
from shelfline.plans.concurrent import run_together
from shelfline.sinks import tables as sink, versions
from shelfline.sources import sample

SMALL = "/root/testdata/sf0.001"
FIRST, SECOND = datetime(2024, 1, 21, 6), datetime(2024, 2, 1, 6)
STAMPS = ["ingestion_date"]


def rows_of(spark, config, name, without=()):
    return sorted(map(tuple, warehouse.read_table(spark, config, name).drop(*without).collect()), key=repr)


@pytest.fixture(scope="module")
def source(spark):
    return sample.with_dimensions(spark, SMALL, sample.dense(spark, SMALL))


@pytest.fixture(scope="module")
def loaded(spark, source, tmp_path_factory):
    config = EngineConfig.under(str(tmp_path_factory.mktemp("wh")), FIRST)
    return config, pipeline.run_pipeline(spark, source, config)


def test_counts_and_audit(spark, source, loaded):
    config, total = loaded
    sizes = {n: warehouse.read_table(spark, config, n).count() for n in warehouse.LAYOUTS}
    assert sizes["dim_product"] == source["product"].count()
    assert sizes["dim_supplier"] == source["supplier"].count()
    moved = [source[n].count() for n in ("purchase_order_detail", "sales_transaction", "stock_adjustment")]
    assert sizes["fact_inventory_movement"] == sum(moved)
    assert total == sum(sizes.values())
    run = warehouse.read_audit(spark, config).collect()
    assert len(run) == 1
    assert run[0]["run_id"] > 0 and (run[0]["run_status"], run[0]["records_loaded"]) == ("SUCCESS", total)
    assert run[0]["records_extracted"] == sum(moved) + sizes["dim_product"] + sizes["dim_supplier"] + source["stock_daily"].count()
    assert (run[0]["dq_checks_passed"], run[0]["dq_checks_failed"], run[0]["error_message"]) == (3, 0, None)
    assert warehouse.get_last_success_date(spark, config) == date(2024, 1, 20)


def test_the_same_run_again_changes_nothing_but_stamps(spark, source, tmp_path):
    config = EngineConfig.under(str(tmp_path), SECOND, lookback_days=400)
    pipeline.run_pipeline(spark, source, config)
    names = ["dim_supplier", "dim_product", "fact_inventory_movement", "fact_daily_inventory"]
    before = {n: rows_of(spark, config, n, STAMPS) for n in names}
    pipeline.run_pipeline(spark, source, EngineConfig.under(str(tmp_path), datetime(2024, 2, 1, 18), lookback_days=400))
    assert {n: rows_of(spark, config, n, STAMPS) for n in names} == before


def test_history_is_clipped_without_lookback_and_whole_with_it(spark, source, tmp_path_factory):
    results = {}
    for lookback in (0, 400):
        base = str(tmp_path_factory.mktemp(f"look{lookback}"))
        for moment in (FIRST, SECOND):
            config = EngineConfig.under(base, moment, lookback_days=lookback)
            pipeline.run_pipeline(spark, source, config)
        results[lookback] = rows_of(spark, config, "fact_daily_inventory", STAMPS)
    chain = pipeline.reorder_chain(
        source["stock_daily"],
        source["purchase_order_detail"],
        source["sales_transaction"],
        source["stock_adjustment"],
        config,
    )
    whole = {(r["inventory_date"], r["product_id"]): r["stock_awal"] for r in chain.collect()}
    position = warehouse.read_table(spark, config, "fact_daily_inventory").drop(*STAMPS).columns
    day, product, opening = (position.index(c) for c in ("inventory_date", "product_id", "stock_awal"))
    assert {(r[day], r[product]): r[opening] for r in results[400]} == whole
    assert len(results[0]) == len(results[400]) and results[0] != results[400]
    assert all(r[opening] == 0 for r in results[0] if r[day] == date(2024, 1, 20))


def test_product_history_across_runs(spark, source, tmp_path):
    config = EngineConfig.under(str(tmp_path), FIRST)
    pipeline.run_pipeline(spark, source, config)
    later = EngineConfig.under(str(tmp_path), SECOND)
    changed = {**source, "product": sample.changed_product(spark, SMALL)}
    pipeline.run_pipeline(spark, changed, later)
    dimension = warehouse.read_table(spark, later, "dim_product")
    closed = dimension.filter("NOT is_current")
    assert closed.count() > 0
    assert {r[0] for r in closed.select("effective_end_date", "end_day").distinct().collect()} == {SECOND}
    assert dimension.filter("is_current").groupBy("product_id").count().filter("count > 1").count() == 0
    assert dimension.select("product_sk").distinct().count() == dimension.count()
    # A third run on the same day has to keep what that day closed already.
    closed_before = {r["product_sk"] for r in closed.collect()}
    pipeline.run_pipeline(spark, source, EngineConfig.under(str(tmp_path), datetime(2024, 2, 1, 20)))
    closed_after = {r["product_sk"] for r in warehouse.read_table(spark, later, "dim_product").filter("NOT is_current").collect()}
    assert closed_before < closed_after


def test_a_failed_gate_stops_the_run_and_keeps_the_warehouse(spark, source, tmp_path):
    config = EngineConfig.under(str(tmp_path), FIRST)
    doubled = {**source, "sales_transaction": source["sales_transaction"].unionAll(source["sales_transaction"])}
    with pytest.raises(DataQualityError, match="fact_inventory_movement"):
        pipeline.run_pipeline(spark, doubled, config)
    marts = {n: versions.current(spark, warehouse.mart_path(config, n)).number for n in warehouse.MART_LAYOUTS}
    assert marts == {"fact_daily_inventory": 1, "fact_inventory_movement": 0, "reorder_recommendations": 1}
    assert not list((tmp_path / "mart" / "fact_inventory_movement").glob("_v=*"))
    assert warehouse.read_table(spark, config, "fact_daily_inventory").count() == 0
    run = warehouse.read_audit(spark, config).first()
    assert (run["run_status"], run["dq_checks_passed"], run["dq_checks_failed"]) == ("FAILED", 2, 1)
    assert "fact_inventory_movement" in run["error_message"]
    assert warehouse.find_running_run(spark, config) is None


def test_a_failed_load_is_audited(spark, source, tmp_path, monkeypatch):
    config = EngineConfig.under(str(tmp_path), FIRST)

    def broken(*_):
        raise RuntimeError("no supplier load")

    monkeypatch.setattr(warehouse, "load_suppliers", broken)
    with pytest.raises(RuntimeError):
        pipeline.run_pipeline(spark, source, config)
    assert [r["run_status"] for r in warehouse.read_audit(spark, config).collect()] == ["FAILED"]
    assert warehouse.read_table(spark, config, "etl_state").count() == 0


def test_missing_inputs(spark, tmp_path):
    config = EngineConfig.under(str(tmp_path), FIRST)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        pipeline.run_transform(spark, config)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        pipeline.generate_daily_inventory_fact(spark, config)
    rows, passed, counts = pipeline.generate_inventory_movement_fact(spark, config)
    assert (rows.count(), passed, counts["nulls"], counts["duplicates"]) == (0, True, 0, 0)
    assert warehouse.load_suppliers(spark, config) == 0
    assert warehouse.load_products_scd2(spark, config) == 0
    assert warehouse.load_fact_inventory_movement(spark, config) == 0
    assert warehouse.load_fact_daily_inventory(spark, config) == 0


def test_a_half_written_feed_is_not_loaded(spark, source, tmp_path):
    config = EngineConfig.under(str(tmp_path), FIRST)
    source["supplier"].write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{config.raw_dir}/suppliers"
    )
    with pytest.raises(ValueError, match="not written to its end"):
        warehouse.load_suppliers(spark, config)


def test_watermark_defaults_to_thirty_days_before_the_run(spark, tmp_path):
    config = EngineConfig.under(str(tmp_path), datetime(2026, 6, 30, 3))
    assert warehouse.get_last_success_date(spark, config) == date(2026, 5, 31)
    warehouse.update_last_success_date(spark, config, date(2026, 6, 1))
    warehouse.update_last_success_date(spark, config, date(2026, 6, 29))
    assert warehouse.get_last_success_date(spark, config) == date(2026, 6, 29)
    assert warehouse.read_table(spark, config, "etl_state").count() == 1


@pytest.mark.parametrize("name", ["suppliers", "products"])
def test_a_null_key_stops_a_dimension_load(spark, source, tmp_path, name):
    config = EngineConfig.under(str(tmp_path), FIRST)
    pipeline.run_extract(spark, source, config)
    path, key = f"{config.raw_dir}/{name}", f"{name[:-1]}_id"
    rows = spark.read.schema(schemas.RAW[name]).parquet(path).collect()
    nulled = spark.createDataFrame([{**r.asDict(), key: None} if i == 0 else r.asDict() for i, r in enumerate(rows)], schemas.RAW[name])
    sink.write_set(nulled, path)
    load = warehouse.load_suppliers if name == "suppliers" else warehouse.load_products_scd2
    with pytest.raises(DataQualityError, match="nulls in key"):
        load(spark, config)


def test_a_broken_extract_is_never_read(spark, source, tmp_path):
    config = EngineConfig.under(str(tmp_path), FIRST)
    pipeline.run_extract(spark, source, config)
    sink.create_marker(spark, warehouse.extracting(config, "sales"))
    for stage in (pipeline.run_transform, pipeline.generate_inventory_movement_fact):
        with pytest.raises(ValueError, match="extract of sales was interrupted"):
            stage(spark, config)
    assert list(pipeline.run_extract(spark, source, config, ["sales"])) == ["sales"]
    (tmp_path / "raw" / "sales" / "_SUCCESS").unlink()
    for stage in (pipeline.run_transform, pipeline.generate_inventory_movement_fact):
        with pytest.raises(ValueError, match="not written to its end"):
            stage(spark, config)
    with pytest.raises(ValueError, match="no such feeds"):
        pipeline.run_extract(spark, source, config, ["nothing"])


def test_a_run_that_fails_early_closes_no_other_run(spark, source, tmp_path, monkeypatch):
    config = EngineConfig.under(str(tmp_path), FIRST)
    other = warehouse.log_audit_start(spark, config)

    def broken(*_):
        raise RuntimeError("no log")

    monkeypatch.setattr(warehouse, "log_audit_start", broken)
    with pytest.raises(RuntimeError):
        pipeline.run_pipeline(spark, source, config)
    assert [(r["run_id"], r["run_status"]) for r in warehouse.read_audit(spark, config).collect()] == [(other, "RUNNING")]


def test_runs_that_start_together_have_ids_of_their_own(spark, tmp_path):
    config = EngineConfig.under(str(tmp_path), FIRST)
    ids = run_together(spark, {str(i): lambda: warehouse.log_audit_start(spark, config) for i in range(4)})
    assert len(set(ids.values())) == 4 == warehouse.read_audit(spark, config).count()


def test_shared_folder_lies_below_the_cluster_setting(spark):
    folder = sink.shared_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != sink.shared_folder(spark)


def test_ending_an_unknown_run_changes_nothing(spark, tmp_path):
    config = EngineConfig.under(str(tmp_path), FIRST)
    run = warehouse.log_audit_start(spark, config)
    warehouse.log_audit_end(spark, config, run + 5, "SUCCESS")
    assert [(r["run_id"], r["run_status"]) for r in warehouse.read_audit(spark, config).collect()] == [(run, "RUNNING")]
    assert warehouse.find_running_run(spark, config)["run_id"] == run
    assert warehouse.log_audit_start(spark, config) > run


# Which run made this set --------------------------------------------------------------------------------


def doubled(source):
    return {**source, "sales_transaction": source["sales_transaction"].unionAll(source["sales_transaction"])}


def test_a_load_alone_refuses_the_marts_of_another_run(spark, source, tmp_path):
    """A good run, then one that its gate stops: a load by itself must not take what the good one left."""
    pipeline.run_pipeline(spark, source, EngineConfig.under(str(tmp_path), FIRST))
    config = EngineConfig.under(str(tmp_path), SECOND)
    with pytest.raises(DataQualityError):
        pipeline.run_pipeline(spark, doubled(source), config)
    before = {n: versions.current(spark, warehouse.table_path(config, n)).number for n in warehouse.LAYOUTS}
    with pytest.raises(warehouse.UncheckedMartError, match="no run is open"):
        pipeline.run_load(spark, config)
    assert warehouse.get_last_success_date(spark, config) == date(2024, 1, 20)
    assert before == {n: versions.current(spark, warehouse.table_path(config, n)).number for n in warehouse.LAYOUTS}


def test_stages_as_separate_jobs(spark, source, tmp_path):
    config = EngineConfig.under(str(tmp_path), FIRST)
    extracted = pipeline.run_extract(spark, source, config)
    run = warehouse.find_running_run(spark, config)["run_id"]
    with pytest.raises(warehouse.UncheckedMartError, match="has not checked"):
        pipeline.run_load(spark, config)
    # That closed the run; another one goes through all stages.
    assert [r["run_status"] for r in warehouse.read_audit(spark, config).collect()] == ["FAILED"]
    pipeline.run_extract(spark, source, config)
    staged = pipeline.run_transform(spark, config)
    reports = pipeline.run_quality_check(spark, config)
    second = warehouse.find_running_run(spark, config)["run_id"]
    assert second != run
    manifest = warehouse.sets_of_run(spark, config, second)
    assert {n: (r["set_rows"], r["verdict"]) for n, r in manifest.items()} == {
        **{f"raw/{n}": (rows, "extracted") for n, rows in extracted.items()},
        "staging/reorder_recommendation": (staged, "transformed"),
        **{f"mart/{n}": (report["row_count"], "passed") for n, report in reports.items()},
    }
    assert {r["set_version"] for n, r in manifest.items() if n.startswith("mart/")} == {1}
    assert pipeline.run_load(spark, config) > 0
    with pytest.raises(warehouse.UncheckedMartError, match="no run is open"):
        pipeline.run_load(spark, config)


def test_a_stage_that_failed_its_gate_is_not_loaded(spark, source, tmp_path):
    config = EngineConfig.under(str(tmp_path), FIRST)
    pipeline.run_extract(spark, doubled(source), config)
    pipeline.run_transform(spark, config)
    with pytest.raises(DataQualityError):
        pipeline.run_quality_check(spark, config)
    with pytest.raises(warehouse.UncheckedMartError, match="has failed fact_inventory_movement"):
        pipeline.run_load(spark, config)
    assert warehouse.read_table(spark, config, "etl_state").count() == 0


def test_a_load_takes_the_versions_that_its_run_checked(spark, source, tmp_path):
    """Another run publishes other marts between check and load."""
    config = EngineConfig.under(str(tmp_path), FIRST)
    pipeline.run_extract(spark, source, config)
    pipeline.run_transform(spark, config)
    run = warehouse.find_running_run(spark, config)["run_id"]
    reports = pipeline.run_quality_check(spark, config)
    empty = warehouse.read_mart(spark, config, "fact_daily_inventory").limit(0)
    base = versions.current(spark, warehouse.mart_path(config, "fact_daily_inventory"))
    versions.replace_partitions(empty, base, ["inventory_date"], whole=True)
    assert warehouse.read_mart(spark, config, "fact_daily_inventory").count() == 0
    pipeline.run_load(spark, config, run)
    assert warehouse.read_table(spark, config, "fact_daily_inventory").count() == reports["fact_daily_inventory"]["row_count"]


def test_marts_are_computed_once(spark, source, tmp_path):
    """Rows pass an accumulator as often as they are computed."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    config = EngineConfig.under(str(tmp_path), FIRST)
    pipeline.run_extract(spark, source, config)
    pipeline.run_transform(spark, config)
    advice = pipeline._advice(spark, config)
    counted = advice.mapInPandas(run, advice.schema)
    rows, passed, counts = pipeline.write_checked(spark, config, "fact_daily_inventory", counted, pipeline.quality.DAILY_RULES)
    assert passed and seen.value == counts["row_count"] == rows.count() > 0
    _, expected = pipeline.quality.check_mart(advice, pipeline.quality.DAILY_RULES)
    assert counts == expected


@pytest.mark.parametrize("fault", ["null", "duplicate"])
def test_a_mart_that_fails_leaves_the_last_one(spark, source, tmp_path, fault):
    config = EngineConfig.under(str(tmp_path), FIRST)
    pipeline.run_extract(spark, source, config)
    pipeline.run_transform(spark, config)
    rows, passed, _ = pipeline.generate_daily_inventory_fact(spark, config)
    good = rows.count()
    broken = rows.withColumn("stock_awal", F.lit(None).cast("bigint")) if fault == "null" else rows.unionAll(rows)
    _, passed, counts = pipeline.write_checked(spark, config, "fact_daily_inventory", broken, pipeline.quality.DAILY_RULES)
    _, expected = pipeline.quality.check_mart(broken, pipeline.quality.DAILY_RULES)
    assert not passed and counts == expected
    assert warehouse.read_mart(spark, config, "fact_daily_inventory").count() == good
    # A mart without a gate is published whatever is found.
    _, passed, counts = pipeline.write_checked(
        spark, config, "reorder_recommendations", broken, pipeline.quality.REORDER_RULES, gated=False
    )
    assert passed and warehouse.read_mart(spark, config, "reorder_recommendations").count() == counts["row_count"]


# Product history in buckets -----------------------------------------------------------------------------


def test_a_load_of_few_changed_products_writes_few_buckets(spark, source, tmp_path):
    config = EngineConfig.under(str(tmp_path), FIRST)
    products = source["product"]

    def load(config, feed):
        sink.write_set(pipeline.conform(feed, schemas.RAW["products"]), f"{config.raw_dir}/products")
        return warehouse.load_products_scd2(spark, config)

    total = load(config, products)
    path = warehouse.table_path(config, "dim_product")
    before = versions.current(spark, path)
    changed = products.withColumn("name", F.when(F.col("product_id").between(1, 10), F.lit("New")).otherwise(F.col("name")))
    later = EngineConfig.under(str(tmp_path), SECOND)
    assert load(later, changed) == 10 < total
    after = versions.current(spark, path)
    rewritten = {p for p, v in after.parts.items() if before.parts.get(p) not in (None, v)}
    assert 1 <= len(rewritten) <= 10 < len(before.parts) and all(p.startswith("end_day=9999-12-31/") for p in rewritten)
    files = list((tmp_path / "warehouse" / "dim_product").glob(f"{after.parts[next(iter(rewritten))]}/end_day=*/product_bucket=*"))
    assert len(files) == len(rewritten) + len(set(after.parts) - set(before.parts))
    dimension = warehouse.read_table(spark, later, "dim_product")
    assert (dimension.filter("is_current").count(), dimension.count()) == (total, total + 10)
    assert load(later, changed) == 0 and versions.current(spark, path) == after


# Carried window state -----------------------------------------------------------------------------------


def test_carried_rows_give_the_figures_of_all_history(spark, source, tmp_path, monkeypatch):
    """Runs that read from their watermark on; one that dies before its watermark moves is repeated."""
    moments = [datetime(2024, 1, 12, 6), datetime(2024, 1, 13, 6), datetime(2024, 1, 20, 6), SECOND]
    for moment in moments:
        config = EngineConfig.under(str(tmp_path), moment, carry_state=True)
        if moment == moments[2]:
            with monkeypatch.context() as broken, pytest.raises(RuntimeError, match="died"):
                broken.setattr(warehouse, "update_last_success_date", lambda *_: (_ for _ in ()).throw(RuntimeError("died")))
                pipeline.run_pipeline(spark, source, config)
        pipeline.run_pipeline(spark, source, config)
    names = ("stock_daily", "purchase_order_detail", "sales_transaction", "stock_adjustment")
    whole = pipeline.reorder_chain(*[source[n] for n in names], config)
    stored = warehouse.read_table(spark, config, "fact_daily_inventory").drop("id", *STAMPS)
    columns = stored.columns
    kinds = dict(stored.dtypes)
    expected = whole.select(*[F.col(c).cast(kinds[c]).alias(c) for c in columns])
    assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    state = warehouse.ledger_state(spark, config)
    assert state.groupBy("product_id").count().agg(F.max("count")).first()[0] <= 29
    assert state.agg(F.max("inventory_date")).first()[0] < config.next_watermark


def test_two_ways_to_the_same_history_are_refused():
    with pytest.raises(ValueError, match="choose one"):
        EngineConfig.under("x", FIRST, carry_state=True, lookback_days=3)
