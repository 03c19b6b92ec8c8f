"""Watermark, run audit and run manifest: views over an append-only log of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.config import DEFAULT_PIPELINE_NAME, FIRST_RUN_WINDOW_DAYS


def read_watermark(state: DataFrame, as_of: Column, pipeline_name: str = DEFAULT_PIPELINE_NAME) -> DataFrame:
    """One row: the last success date of a pipeline, or 30 days before the run if it never succeeded."""
    first_run = F.date_sub(as_of.cast("date"), FIRST_RUN_WINDOW_DAYS)
    return state.filter(F.col("pipeline_name") == pipeline_name).agg(
        F.coalesce(F.max("last_success_date"), first_run).alias("last_success_date")
    )


def audit_start(run_id: Column, pipeline_name: Column, event_time: Column) -> list[Column]:
    """Columns of the event that opens a run."""
    zero = F.lit(0)
    return _event(run_id, pipeline_name, F.lit("RUNNING"), event_time, False, zero, zero, zero, zero, F.lit(None))


def audit_progress(
    run_id: Column, pipeline_name: Column, event_time: Column, *counters: Column
) -> list[Column]:
    """Columns of an event that records counters (extracted, loaded, checks passed and failed) so far."""
    return _event(run_id, pipeline_name, F.lit("RUNNING"), event_time, False, *counters, F.lit(None))


def audit_end(
    run_id: Column,
    pipeline_name: Column,
    status: Column,
    event_time: Column,
    records_extracted: Column | None = None,
    records_loaded: Column | None = None,
    dq_passed: Column | None = None,
    dq_failed: Column | None = None,
    error_message: Column | None = None,
) -> list[Column]:
    """Columns of the event that closes a run."""
    counters = [
        F.lit(0) if c is None else c for c in (records_extracted, records_loaded, dq_passed, dq_failed)
    ]
    message = F.lit(None) if error_message is None else error_message
    return _event(run_id, pipeline_name, status, event_time, True, *counters, message)


def audit_log(events: DataFrame) -> DataFrame:
    """One row per run: its start, and the state its latest event left it in.

    The log is append-only; ending a run adds an event. The fold combines inside each task before the
    shuffle. A closing event of a run that never started changes nothing.
    """
    state = F.struct(
        "run_status", "records_extracted", "records_loaded", "dq_checks_passed", "dq_checks_failed", "error_message"
    )
    runs = events.groupBy("run_id").agg(
        F.min(F.when(~F.col("is_closing"), F.struct("event_time", "pipeline_name"))).alias("opened"),
        F.max(F.when(F.col("is_closing"), F.col("event_time"))).alias("end_time"),
        F.max_by(state, F.struct("is_closing", "event_time")).alias("latest"),
    )
    return runs.filter("opened IS NOT NULL").select(
        "run_id",
        F.col("opened.pipeline_name").alias("pipeline_name"),
        F.col("latest.run_status").alias("run_status"),
        F.col("opened.event_time").alias("start_time"),
        "end_time",
        *[
            F.col(f"latest.{c}").alias(c)
            for c in ("records_extracted", "records_loaded", "dq_checks_passed", "dq_checks_failed", "error_message")
        ],
    )


def latest_running_run(audit: DataFrame) -> DataFrame:
    """The run that started last among those still running (no row if there is none)."""
    return (
        audit.filter("run_status = 'RUNNING'")
        .orderBy(F.col("start_time").desc(), F.col("run_id").desc())
        .limit(1)
    )


# What an event tells of.
RUN, SET, WATERMARK = "run", "set", "watermark"
_GROUP = ("kind", "run_id", "pipeline_name", "set_name", "is_closing")


def watermarks(events: DataFrame) -> DataFrame:
    """One row per pipeline: what its latest watermark event says, with the version of the ledger state that belongs to it."""
    said = F.struct("last_success_date", "updated_at", F.col("set_version").alias("state_version"))
    latest = F.max_by(said, F.struct("event_time", "event_id"))
    marks = events.filter(F.col("kind") == WATERMARK).groupBy("pipeline_name").agg(latest.alias("latest"))
    return marks.select("pipeline_name", "latest.*")


def manifest(events: DataFrame) -> DataFrame:
    """One row per run and set: the version, row count and verdict that the run recorded last."""
    latest = F.max_by(F.struct("set_version", "set_rows", "verdict"), F.struct("event_time", "event_id"))
    sets = events.filter(F.col("kind") == SET).groupBy("run_id", "set_name").agg(latest.alias("latest"))
    return sets.select("run_id", "set_name", "latest.set_version", "latest.set_rows", "latest.verdict")


def folded(events: DataFrame) -> DataFrame:
    """The events that the views can still tell apart from none: the first and the last of each group.

    A group is a run, a set of a run or a watermark, closing events apart from others. Folding again, folding parts
    first, or folding an event twice gives the same.
    """
    order, row = F.struct("event_time", "event_id"), F.struct(*events.columns)
    ends = events.groupBy(*[F.col(c).alias(f"_{c}") for c in _GROUP]).agg(
        F.array_distinct(F.array(F.min_by(row, order), F.max_by(row, order))).alias("ends")
    )
    return ends.select(F.inline("ends"))


def _event(
    run_id: Column,
    pipeline_name: Column,
    status: Column,
    event_time: Column,
    closing: bool,
    extracted: Column,
    loaded: Column,
    passed: Column,
    failed: Column,
    message: Column,
) -> list[Column]:
    return [
        run_id.cast("bigint").alias("run_id"),
        pipeline_name.cast("string").alias("pipeline_name"),
        status.cast("string").alias("run_status"),
        event_time.cast("timestamp_ntz").alias("event_time"),
        F.lit(closing).alias("is_closing"),
        extracted.cast("bigint").alias("records_extracted"),
        loaded.cast("bigint").alias("records_loaded"),
        passed.cast("int").alias("dq_checks_passed"),
        failed.cast("int").alias("dq_checks_failed"),
        message.cast("string").alias("error_message"),
    ]
