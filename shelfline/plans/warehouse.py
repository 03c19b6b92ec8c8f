"""Warehouse tables: where they lie, how they are read, and the loads that merge marts into them."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from shelfline import schemas
from shelfline.config import EngineConfig
from shelfline.functions.times import wall_clock
from shelfline.operators import control, merge, quality, scd2
from shelfline.plans import control_log
from shelfline.sinks import versions
from shelfline.sinks.tables import write_set
from shelfline.sinks.versions import Snapshot
from shelfline.sources.files import path_exists, scan_complete, scan_set

logger = logging.getLogger(__name__)


class UncheckedMartError(RuntimeError):
    """A mart that the run has not built and checked is not loaded."""


@dataclass(frozen=True)
class Layout:
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()


# Partition columns are functions of the merge key, so an upsert touches just the partitions of its feed.
LAYOUTS = {
    "dim_supplier": Layout(cluster_by=("supplier_id",)),
    "dim_product": Layout(("end_day", "product_bucket"), ("product_id",)),
    "fact_inventory_movement": Layout(("movement_type", "ref_bucket"), ("movement_date", "product_id")),
    "fact_daily_inventory": Layout(("inventory_date",), ("product_id",)),
}

MART_LAYOUTS = {
    "fact_daily_inventory": Layout(("inventory_date",), ("product_id",)),
    "fact_inventory_movement": Layout(),
    "reorder_recommendations": Layout(),
}


def table_path(config: EngineConfig, name: str) -> str:
    return f"{config.warehouse_dir}/{name}"


def mart_path(config: EngineConfig, name: str) -> str:
    return f"{config.mart_dir}/{name}"


def read_table(spark: SparkSession, config: EngineConfig, name: str) -> DataFrame:
    """The current version of a warehouse table; `etl_state` is a view of the control log."""
    if name == "etl_state":
        return control.watermarks(control_events(spark, config)).drop("state_version")
    return versions.read(spark, versions.current(spark, table_path(config, name)), schemas.WAREHOUSE[name])


def read_mart(spark: SparkSession, config: EngineConfig, name: str) -> DataFrame:
    return versions.read(spark, versions.current(spark, mart_path(config, name)), schemas.MART[name])


def replace_rows(name: str, rows: DataFrame, base: Snapshot, rebalance: bool = True) -> int:
    """Replace the partitions of a table that `rows` holds, in the version that it started from."""
    layout = LAYOUTS[name]
    return versions.replace_partitions(rows, base, layout.partition_by, layout.cluster_by, rebalance=rebalance).rows


def remove_old_versions(spark: SparkSession, config: EngineConfig, keep: int = 1) -> None:
    """Remove the versions of all tables and marts but the latest `keep`, and the folded part of the control log.

    Call it when no reader has an older version open.
    """
    for name in LAYOUTS:
        versions.remove_old(spark, table_path(config, name), keep)
    for name in MART_LAYOUTS:
        versions.remove_old(spark, mart_path(config, name), keep)
    versions.remove_old(spark, state_path(config), max(keep, 2))
    control_log.remove_folded(spark, log_path(config))


def run_time(config: EngineConfig) -> Column:
    return wall_clock(config.as_of)


# Control log --------------------------------------------------------------------------------------------


def log_path(config: EngineConfig) -> str:
    return table_path(config, "etl_log")


def control_events(spark: SparkSession, config: EngineConfig) -> DataFrame:
    return control_log.events(spark, log_path(config))


def get_last_success_date(spark: SparkSession, config: EngineConfig) -> date:
    state = read_table(spark, config, "etl_state")
    return control.read_watermark(state, run_time(config), config.pipeline_name).first()[0]


def update_last_success_date(spark: SparkSession, config: EngineConfig, day: date, state: int | None = None) -> None:
    """Advance the watermark: an event, so nothing is read that another run could change meanwhile.

    It names the version of the ledger state that the next run goes on from, so the two move in one step.
    """
    names = {"pipeline_name": config.pipeline_name, "updated_at": config.as_of}
    control_log.append(spark, log_path(config), control.WATERMARK, last_success_date=day, set_version=state, **names)


def state_path(config: EngineConfig) -> str:
    return table_path(config, f"ledger_state/{config.pipeline_name}")


def ledger_state(spark: SparkSession, config: EngineConfig) -> DataFrame:
    """The ledger rows that the last run which succeeded has left for the next one; none before the first."""
    marks = control.watermarks(control_events(spark, config)).filter(F.col("pipeline_name") == config.pipeline_name)
    row = marks.first()
    known = versions.at(spark, state_path(config), (row and row["state_version"]) or 0)
    return versions.read(spark, known, schemas.LEDGER)


def publish_ledger_state(spark: SparkSession, config: EngineConfig) -> int:
    """Make the staged state a version of its own; nobody reads it until a watermark names it."""
    path = f"{config.staging_dir}/ledger_state"
    staged = scan_complete(spark, path, schemas.STAGING["ledger_state"])
    base = versions.current(spark, state_path(config))
    return versions.replace_partitions(staged, base, whole=True).number


def read_audit(spark: SparkSession, config: EngineConfig) -> DataFrame:
    return control.audit_log(control_events(spark, config).filter(F.col("kind") == control.RUN))


def read_manifest(spark: SparkSession, config: EngineConfig) -> DataFrame:
    return control.manifest(control_events(spark, config))


def log_audit_start(spark: SparkSession, config: EngineConfig) -> int:
    """Open a run; returns its id. Ids grow with time, and two runs that start together have different ones."""
    control_log.fold_if_long(spark, log_path(config))
    run_id = (time.time_ns() // 1_000_000 << 20) | uuid.uuid4().int & (1 << 20) - 1
    _log_run(spark, config, run_id, "RUNNING", False)
    return run_id


def log_audit_progress(
    spark: SparkSession, config: EngineConfig, run_id: int, records_extracted: int, dq_passed: int = 0, dq_failed: int = 0
) -> None:
    """Record counters of a stage while the run goes on, for the stages after it."""
    _log_run(spark, config, run_id, "RUNNING", False, records_extracted, 0, dq_passed, dq_failed)


def log_audit_end(
    spark: SparkSession,
    config: EngineConfig,
    run_id: int,
    status: str,
    records_extracted: int = 0,
    records_loaded: int = 0,
    dq_passed: int = 0,
    dq_failed: int = 0,
    error_message: str | None = None,
) -> None:
    counters = (records_extracted, records_loaded, dq_passed, dq_failed)
    _log_run(spark, config, run_id, status, True, *counters, error_message)


def _log_run(
    spark: SparkSession,
    config: EngineConfig,
    run_id: int,
    status: str,
    closing: bool,
    extracted: int = 0,
    loaded: int = 0,
    passed: int = 0,
    failed: int = 0,
    message: str | None = None,
) -> None:
    control_log.append(
        spark,
        log_path(config),
        control.RUN,
        run_id=run_id,
        pipeline_name=config.pipeline_name,
        run_status=status,
        is_closing=closing,
        records_extracted=extracted,
        records_loaded=loaded,
        dq_checks_passed=passed,
        dq_checks_failed=failed,
        error_message=message,
    )


def log_set(
    spark: SparkSession, config: EngineConfig, run_id: int | None, name: str, rows: int, verdict: str, version: int | None = None
) -> None:
    """Record in the manifest of a run what it made of a set; without a run there is nothing to record it for."""
    if run_id is not None:
        control_log.append(
            spark, log_path(config), control.SET,
            run_id=run_id, set_name=name, set_version=version, set_rows=rows, verdict=verdict,
        )


def find_running_run(spark: SparkSession, config: EngineConfig, run_id: int | None = None) -> Row | None:
    """Audit row of a run that is running: the one with this id, or the latest of this pipeline.

    A log that cannot be read gives no run: other stages go on without their audit row, a load refuses.
    """
    try:
        runs = read_audit(spark, config).filter(F.col("pipeline_name") == config.pipeline_name)
        if run_id is not None:
            runs = runs.filter(F.col("run_id") == run_id)
        return control.latest_running_run(runs).first()
    except Exception as error:  # noqa: BLE001
        logger.warning("no running run found: %s", error)
        return None


def sets_of_run(spark: SparkSession, config: EngineConfig, run_id: int) -> dict[str, Row]:
    """The manifest of a run: what it recorded for each of its sets."""
    mine = control_events(spark, config).filter(F.col("run_id") == run_id)
    return {r["set_name"]: r for r in control.manifest(mine).collect()}


def checked_marts(spark: SparkSession, config: EngineConfig, run_id: int | None) -> dict[str, Snapshot]:
    """The versions of the marts that this run has built and passed; raises if there is one that it hasn't."""
    if run_id is None:
        raise UncheckedMartError("no run is open: extract, transform and check first")
    recorded = sets_of_run(spark, config, run_id)
    found = {}
    for name in MART_LAYOUTS:
        entry = recorded.get(f"mart/{name}")
        if entry is None or entry["verdict"] != "passed":
            reason = "has not checked" if entry is None else "has failed"
            raise UncheckedMartError(f"run {run_id} {reason} {name}: nothing is loaded")
        found[name] = versions.at(spark, mart_path(config, name), entry["set_version"])
    return found


# Raw sets -------------------------------------------------------------------------------------------------


def extracting(config: EngineConfig, name: str) -> str:
    """The marker that stands beside a raw set from the start of its extract until it is complete."""
    return f"{config.raw_dir}/_EXTRACTING.{name}"


def raw_feed(spark: SparkSession, config: EngineConfig, name: str) -> DataFrame | None:
    """A raw set that was written to its end, or None if there is none; one whose extract broke off raises."""
    if path_exists(spark, extracting(config, name)):
        raise ValueError(f"the extract of {name} was interrupted: run it again")
    return _feed(spark, f"{config.raw_dir}/{name}", schemas.RAW[name])


def raw_set(spark: SparkSession, config: EngineConfig, name: str, may_be_absent: bool = False) -> DataFrame:
    feed = raw_feed(spark, config, name)
    if feed is not None:
        return feed
    if may_be_absent:
        return spark.createDataFrame([], schemas.RAW[name])
    return scan_set(spark, f"{config.raw_dir}/{name}", schemas.RAW[name])


# Loads --------------------------------------------------------------------------------------------------


def load_suppliers(spark: SparkSession, config: EngineConfig) -> int:
    feed = raw_feed(spark, config, "suppliers")
    if feed is None:
        return 0
    count = quality.unique_rows(feed, ["supplier_id"])
    base = versions.current(spark, table_path(config, "dim_supplier"))
    target = versions.read(spark, base, schemas.WAREHOUSE["dim_supplier"])
    replace_rows("dim_supplier", merge.supplier_upsert(target, feed, run_time(config)), base)
    return count


def load_products_scd2(spark: SparkSession, config: EngineConfig, several: bool = False) -> int:
    """Returns the number of versions opened; without any, nothing is written.

    Three steps, each on less: digests of all open versions tell which products may have changed; those are compared with
    their open versions; the buckets of the products that did change are written anew.

    A product may occur twice in the feed as long as one of its rows, at most, opens a version: a row that says what the
    dimension has opens none. Two that each would open one are refused, as are rows without a product. With `several`, for a
    feed that is known to name products more than once, each such row opens a version of its own.
    """
    feed = raw_feed(spark, config, "products")
    if feed is None:
        return 0
    base = versions.current(spark, table_path(config, "dim_product"))
    dimension = versions.read(spark, base, schemas.WAREHOUSE["dim_product"])
    path = f"{config.staging_dir}/product_changes"
    buckets = config.product_buckets
    opened = write_set(scd2.product_changes(dimension.filter(scd2.is_open()), feed), path)
    if not opened:
        return 0
    changes = scan_set(spark, path, schemas.STAGING["product_changes"])
    if several:
        quality.require_keys(changes, ["product_id"])
    else:
        quality.require_unique(changes, ["product_id"])
    bucket = scd2.product_bucket(F.col("product_id"), buckets)
    touched = [r[0] for r in changes.select(bucket).distinct().collect()]
    # Open versions, and those that this day has closed already: the only partitions of these buckets that can change.
    around = dimension.filter(F.col("end_day").isin(scd2.OPEN_DAY, config.as_of.date()) & F.col("product_bucket").isin(touched))
    highest = dimension.filter(scd2.is_open()).agg(F.coalesce(F.max("product_sk"), F.lit(0).cast("bigint"))).first()[0]
    rows = scd2.apply_changes(around, changes, run_time(config), buckets, F.lit(highest))
    replace_rows("dim_product", rows, base)
    return opened


def load_fact_inventory_movement(spark: SparkSession, config: EngineConfig, mart: Snapshot | None = None) -> int:
    feed, count = _mart(spark, config, "fact_inventory_movement", mart)
    rows = merge.movement_rows(feed, run_time(config), config.movement_bucket_span)
    return _load_fact(spark, config, "fact_inventory_movement", rows, count, merge.MOVEMENT_KEY)


def load_fact_daily_inventory(spark: SparkSession, config: EngineConfig, mart: Snapshot | None = None) -> int:
    feed, count = _mart(spark, config, "fact_daily_inventory", mart)
    return _load_fact(spark, config, "fact_daily_inventory", merge.daily_rows(feed, run_time(config)), count, merge.DAILY_KEY)


def _mart(spark: SparkSession, config: EngineConfig, name: str, mart: Snapshot | None) -> tuple[DataFrame, int]:
    """A version of a mart (the current one, if none is given) and its rows, which were counted while it was written."""
    if mart is None:
        mart = versions.current(spark, mart_path(config, name))
    if not mart.number:
        logger.warning("%s is absent, its load is skipped", mart.path)
    return versions.read(spark, mart, schemas.MART[name]), mart.rows


def _load_fact(
    spark: SparkSession, config: EngineConfig, name: str, rows: DataFrame, count: int, keys: Sequence[str]
) -> int:
    """Merge mart rows (unique by key, as their gate has checked) into the partitions they touch.

    A feed that is small by its count leaves the rows of those partitions where their scan has them.
    """
    if count:
        base = versions.current(spark, table_path(config, name))
        partition_by = LAYOUTS[name].partition_by
        target = versions.read(spark, versions.touched(base, rows, partition_by), schemas.WAREHOUSE[name])
        merged, in_place = merge.merge_in_place(target, rows, keys, count, partition_by)
        replace_rows(name, merged, base, rebalance=not in_place)
    return count


def _feed(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    if not path_exists(spark, path):
        logger.warning("%s is absent, its load is skipped", path)
        return None
    return scan_complete(spark, path, schema)
