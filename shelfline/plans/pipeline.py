"""The four stages. Each can run as its own job: what passes between them lies in the layer folders."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from shelfline import schemas
from shelfline.config import EngineConfig
from shelfline.operators import movements, quality
from shelfline.operators.ledger import carried_over, continued_snapshot, daily_figures, inventory_snapshot
from shelfline.operators.metrics import CARRIED_ROWS, turnover_metrics
from shelfline.operators.quality import DataQualityError
from shelfline.operators.reorder import reorder_analysis
from shelfline.plans import warehouse
from shelfline.plans.concurrent import run_together
from shelfline.sinks import versions
from shelfline.sinks.tables import create_marker, remove_folder, write_set
from shelfline.sources import feeds
from shelfline.sources.files import conform, scan_complete

logger = logging.getLogger(__name__)

MartResult = tuple[DataFrame, bool, dict[str, int]]


# Extract ------------------------------------------------------------------------------------------------


def extract_feeds(tables: dict[str, DataFrame], since: date) -> dict[str, DataFrame]:
    """The six raw feeds. `purchases` may come joined already, as from a JDBC source."""
    if "purchases" in tables:
        purchases = tables["purchases"].filter(F.col("received_date") >= F.lit(since).cast("timestamp_ntz"))
    else:
        purchases = feeds.incremental_purchases(
            tables["purchase_order_detail"], tables["purchase_order_header"], since
        )
    return {
        "products": feeds.products(tables["product"]),
        "suppliers": feeds.suppliers(tables["supplier"]),
        "sales": feeds.incremental_sales(tables["sales_transaction"], since),
        "purchases": purchases.select(*feeds.PURCHASE_COLUMNS),
        "adjustments": feeds.incremental_adjustments(tables["stock_adjustment"], since),
        "stock_daily": feeds.incremental_stock_daily(tables["stock_daily"], since),
    }


def run_extract(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    config: EngineConfig,
    names: Sequence[str] | None = None,
    run_id: int | None = None,
) -> dict[str, int]:
    """Read the watermark and store the raw sets, all or those named. Returns rows per set.

    A set is marked while it is extracted, so that one that broke off is never read. Without the id of a run that is
    open already, a run is opened in the audit.
    """
    if run_id is None:
        run_id = warehouse.log_audit_start(spark, config)
    since = config.read_since(warehouse.get_last_success_date(spark, config))
    wanted = {n: f for n, f in extract_feeds(tables, since).items() if names is None or n in names}
    if names is not None and set(names) - set(wanted):
        raise ValueError(f"no such feeds: {sorted(set(names) - set(wanted))}")
    for name in wanted:
        create_marker(spark, warehouse.extracting(config, name))
    counts = run_together(spark, {name: partial(_extract, spark, config, name, feed) for name, feed in wanted.items()})
    for name, count in counts.items():
        warehouse.log_set(spark, config, run_id, f"raw/{name}", count, "extracted")
    warehouse.log_audit_progress(spark, config, run_id, records_extracted=sum(counts.values()))
    return counts


def _extract(spark: SparkSession, config: EngineConfig, name: str, feed: DataFrame) -> int:
    count = write_set(conform(feed, schemas.RAW[name]), f"{config.raw_dir}/{name}")
    remove_folder(spark, warehouse.extracting(config, name))
    return count


# Transform ----------------------------------------------------------------------------------------------


def reorder_chain(
    stock_daily: DataFrame, purchases: DataFrame, sales: DataFrame, adjustments: DataFrame, config: EngineConfig
) -> DataFrame:
    """Ledger, metrics and reorder advice as one plan: nothing is stored between the steps."""
    return (
        inventory_snapshot(stock_daily, purchases, sales, adjustments)
        .transform(turnover_metrics)
        .transform(reorder_analysis, config.lead_time_days, config.safety_stock_days)
    )


def continued_chain(
    stock_daily: DataFrame,
    purchases: DataFrame,
    sales: DataFrame,
    adjustments: DataFrame,
    carried: DataFrame,
    config: EngineConfig,
) -> DataFrame:
    """Advice for new days after carried ledger rows, and those rows, told apart by `is_carried`."""
    daily = daily_figures(stock_daily, purchases, sales, adjustments)
    return (
        continued_snapshot(daily, carried)
        .transform(turnover_metrics)
        .transform(reorder_analysis, config.lead_time_days, config.safety_stock_days)
    )


def run_transform(spark: SparkSession, config: EngineConfig, run_id: int | None = None) -> int:
    """Store the reorder advice of all raw days; days read only as lookback are left out."""
    if run_id is None:
        run_id = _id(warehouse.find_running_run(spark, config))
    raw = {n: warehouse.raw_set(spark, config, n) for n in ("stock_daily", "purchases", "sales", "adjustments")}
    if config.carry_state:
        since = warehouse.get_last_success_date(spark, config)
        carried = warehouse.ledger_state(spark, config).filter(F.col("inventory_date") < F.lit(since))
        path = f"{config.staging_dir}/continued"
        write_set(continued_chain(**raw, carried=carried, config=config), path)
        rows = scan_complete(spark, path, f"{schemas.STAGING['reorder_recommendation']}, is_carried BOOLEAN")
        # The next run reads the day of its watermark again, so it goes on from the rows before that day.
        write_set(carried_over(rows, config.next_watermark, CARRIED_ROWS), f"{config.staging_dir}/ledger_state")
        advice = rows.filter("NOT is_carried").drop("is_carried")
    else:
        advice = reorder_chain(**raw, config=config)
    if config.lookback_days:
        advice = advice.filter(F.col("inventory_date") >= F.lit(warehouse.get_last_success_date(spark, config)))
    count = write_set(advice, f"{config.staging_dir}/reorder_recommendation")
    warehouse.log_set(spark, config, run_id, "staging/reorder_recommendation", count, "transformed")
    return count


def _id(run: Row | None) -> int | None:
    return None if run is None else run["run_id"]


# Quality and marts --------------------------------------------------------------------------------------


def write_checked(
    spark: SparkSession,
    config: EngineConfig,
    name: str,
    rows: DataFrame,
    rules: quality.MartRules,
    run_id: int | None = None,
    gated: bool = True,
) -> MartResult:
    """Write a mart, check what was written, and make it current only if it passes: (rows, passed, counts).

    The rows are computed and written once. Nulls, negatives and rows are observed while they are written, duplicates
    are counted on the key columns of the files. A mart that fails leaves the last one in place. Without a gate it
    becomes current whatever the checks find. The verdict goes into the run's manifest.
    """
    if set(rules.key) - set(rows.columns):
        _, counts = quality.check_mart(rows, rules)
        warehouse.log_set(spark, config, run_id, f"mart/{name}", counts["row_count"], "failed")
        return rows, False, counts
    for absent in set(rules.not_null) - set(rows.columns):
        logger.warning("null check skips absent column %s", absent)
    layout, schema = warehouse.MART_LAYOUTS[name], schemas.MART[name]
    base = versions.current(spark, warehouse.mart_path(config, name))
    candidate = versions.write_candidate(rows, base, layout.partition_by, layout.cluster_by, quality.measures(rows, rules))
    seen = candidate.observed
    counts = {"row_count": seen["rows"], "nulls": seen["nulls"], "duplicates": 0, "biz_warnings": seen["biz_warnings"]}
    if rules.key:
        keys = versions.read_candidate(spark, candidate, schema).select(*rules.key)
        counts["duplicates"] = quality.duplicate_report(keys, rules.key).first()["duplicate_count"]
    if gated and (counts["nulls"] or counts["duplicates"]):
        versions.discard(spark, candidate)
        warehouse.log_set(spark, config, run_id, f"mart/{name}", seen["rows"], "failed")
        return rows, False, counts
    published = versions.publish(spark, candidate, whole=True)
    warehouse.log_set(spark, config, run_id, f"mart/{name}", seen["rows"], "passed", published.number)
    return versions.read(spark, published, schema), True, counts


def generate_daily_inventory_fact(spark: SparkSession, config: EngineConfig, run_id: int | None = None) -> MartResult:
    """(rows, passed, counts); the mart becomes current only if no key is NULL or duplicated."""
    return write_checked(spark, config, "fact_daily_inventory", _advice(spark, config), quality.DAILY_RULES, run_id)


def generate_inventory_movement_fact(spark: SparkSession, config: EngineConfig, run_id: int | None = None) -> MartResult:
    """(rows, passed, counts). Absent feeds count as empty, and an empty mart is written as such."""
    raw = {n: warehouse.raw_set(spark, config, n, may_be_absent=True) for n in ("purchases", "sales", "adjustments")}
    rows = movements.inventory_movements(**raw)
    if config.lookback_days:
        rows = rows.filter(F.col("movement_date") >= F.lit(warehouse.get_last_success_date(spark, config)))
    return write_checked(spark, config, "fact_inventory_movement", rows, quality.MOVEMENT_RULES, run_id)


def generate_reorder_recommendations_mart(spark: SparkSession, config: EngineConfig, run_id: int | None = None) -> MartResult:
    """(rows, True, counts): the rows to reorder, current whatever the check finds."""
    rows = reorder_mart(_advice(spark, config))
    return write_checked(spark, config, "reorder_recommendations", rows, quality.REORDER_RULES, run_id, gated=False)


def reorder_mart(advice: DataFrame) -> DataFrame:
    return advice.filter("reorder_alert")


def run_quality_check(spark: SparkSession, config: EngineConfig, run_id: int | None = None) -> dict[str, dict[str, int]]:
    """Build the three marts; raises if a critical check failed, so that nothing is loaded."""
    run = warehouse.find_running_run(spark, config, run_id)
    makers = {
        "fact_daily_inventory": generate_daily_inventory_fact,
        "fact_inventory_movement": generate_inventory_movement_fact,
        "reorder_recommendations": generate_reorder_recommendations_mart,
    }
    results = run_together(spark, {name: partial(make, spark, config, _id(run)) for name, make in makers.items()})
    failed = [name for name, (_, passed, _) in results.items() if not passed]
    reports = {name: counts for name, (_, _, counts) in results.items()}
    if run is not None:
        extracted, passed = run["records_extracted"], len(results) - len(failed)
        warehouse.log_audit_progress(spark, config, run["run_id"], extracted, passed, len(failed))
    if failed:
        raise DataQualityError(f"critical checks failed: {', '.join(f'{n} {reports[n]}' for n in failed)}")
    return reports


def _advice(spark: SparkSession, config: EngineConfig) -> DataFrame:
    path = f"{config.staging_dir}/reorder_recommendation"
    return scan_complete(spark, path, schemas.STAGING["reorder_recommendation"])


# Load ---------------------------------------------------------------------------------------------------


def run_load(spark: SparkSession, config: EngineConfig, run_id: int | None = None) -> int:
    """Merge dimensions and facts, advance the watermark and close the run. Returns the rows loaded.

    Loads the versions of the marts that this run (or else the latest that is running) has built and passed, and
    raises if there are none: marts that another run left behind are never taken for its own.
    """
    run = warehouse.find_running_run(spark, config, run_id)
    try:
        marts = warehouse.checked_marts(spark, config, _id(run))
        counts = run_together(
            spark,
            {
                "dim_supplier": partial(warehouse.load_suppliers, spark, config),
                "dim_product": partial(warehouse.load_products_scd2, spark, config),
                "fact_inventory_movement": partial(warehouse.load_fact_inventory_movement, spark, config, marts["fact_inventory_movement"]),
                "fact_daily_inventory": partial(warehouse.load_fact_daily_inventory, spark, config, marts["fact_daily_inventory"]),
            },
        )
        loaded = sum(counts.values())
        state = warehouse.publish_ledger_state(spark, config) if config.carry_state else None
        warehouse.update_last_success_date(spark, config, config.next_watermark, state)
    except Exception as error:
        _close_run(spark, config, run, "FAILED", error=error)
        raise
    _close_run(spark, config, run, "SUCCESS", loaded)
    return loaded


def _close_run(
    spark: SparkSession,
    config: EngineConfig,
    run: Row | None,
    status: str,
    loaded: int = 0,
    error: Exception | None = None,
) -> None:
    if run is None:
        return
    warehouse.log_audit_end(
        spark,
        config,
        run["run_id"],
        status,
        records_extracted=run["records_extracted"],
        records_loaded=loaded,
        dq_passed=run["dq_checks_passed"],
        dq_failed=run["dq_checks_failed"],
        error_message=None if error is None else str(error),
    )


# Whole run ----------------------------------------------------------------------------------------------


def run_pipeline(spark: SparkSession, tables: dict[str, DataFrame], config: EngineConfig) -> int:
    """Extract, transform, check and load; the first failure stops the run and closes its own audit row."""
    run_id = warehouse.log_audit_start(spark, config)
    try:
        run_extract(spark, tables, config, run_id=run_id)
        run_transform(spark, config, run_id)
        run_quality_check(spark, config, run_id)
    except Exception as error:
        _close_run(spark, config, warehouse.find_running_run(spark, config, run_id), "FAILED", error=error)
        raise
    return run_load(spark, config, run_id)
