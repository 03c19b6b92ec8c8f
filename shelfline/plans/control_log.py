"""The log that runs, their sets and watermarks are kept in: events as they come, folded into snapshots.

    <log>/events/e=<epoch>/<event>.json     one file per event, each under a name of its own
    <log>/<versions>                        snapshots: what all events of earlier epochs fold to

An event never changes, so writers need no turns and lose nothing: two pipelines that advance their watermarks at once
both append. The epoch is the number of the snapshot that a writer sees. A snapshot folds its predecessor and the events of
the last two epochs, and a reader takes the latest snapshot and those epochs again; folding an event twice changes nothing, so an
event that came too late for one snapshot is in the next. A writer that finds two new snapshots after its event appends it again.
A reader so opens one snapshot and the events since, however many there have been.
"""

from __future__ import annotations

import json
import uuid
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession

from shelfline import schemas
from shelfline.operators import control
from shelfline.sinks import versions
from shelfline.sinks.tables import hadoop_path, remove_folder
from shelfline.sources.files import path_exists

#: Events of an epoch before the next start of a run folds them.
FOLD_AFTER = 128
_SCHEMA = schemas.WAREHOUSE["etl_log"]
_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "mode": "FAILFAST"}


def append(spark: SparkSession, log: str, kind: str, **fields: str | int | bool | date | datetime | None) -> None:
    """Append one event. Its time is the moment of this call: the one place where a run reads the clock."""
    event = {"event_id": uuid.uuid4().hex, "kind": kind, "event_time": datetime.now(UTC).replace(tzinfo=None), **fields}
    line = json.dumps({k: _shown(v) for k, v in event.items() if v is not None})
    epoch = _epoch(spark, log)
    _write(spark, _folder(log, epoch), event["event_id"], line)
    while (now := _epoch(spark, log)) > epoch + 1:
        epoch = now
        _write(spark, _folder(log, epoch), event["event_id"], line)


def events(spark: SparkSession, log: str) -> DataFrame:
    """The folded events of the latest snapshot and those of the last epochs; an event may be among both."""
    snapshot = versions.current(spark, log)
    found = versions.read(spark, snapshot, _SCHEMA)
    recent = [f for e in (snapshot.number - 1, snapshot.number) if path_exists(spark, f := _folder(log, e))]
    if not recent:
        return found
    fresh = spark.read.schema(_SCHEMA).options(**_JSON).json(recent)
    return found.unionByName(fresh) if snapshot.number else fresh


def fold(spark: SparkSession, log: str, more: DataFrame | None = None) -> bool:
    """Write a snapshot of everything so far, with `more` events if there are any.

    False if another one came first; then nothing is lost but `more`.
    """
    base = versions.current(spark, log)
    everything = events(spark, log)
    if more is not None:
        everything = everything.unionByName(more)
    candidate = versions.write_candidate(control.folded(everything), base)
    try:
        versions.publish(spark, candidate, whole=True)
    except versions.VersionConflict:
        return False
    return True


def fold_if_long(spark: SparkSession, log: str, after: int = FOLD_AFTER) -> bool:
    folder = _folder(log, _epoch(spark, log))
    if not path_exists(spark, folder):
        return False
    fs, path = hadoop_path(spark, folder)
    return len(fs.listStatus(path)) > after and fold(spark, log)


def remove_folded(spark: SparkSession, log: str) -> None:
    """Remove snapshots and epochs that nothing reads any more, but for the last two of each that are out of use."""
    latest = _epoch(spark, log)
    if path_exists(spark, f"{log}/events"):
        fs, path = hadoop_path(spark, f"{log}/events")
        epochs = [int(str(f.getPath().getName()).removeprefix("e=")) for f in fs.listStatus(path)]
        for epoch in epochs:
            if epoch < latest - 3:
                remove_folder(spark, _folder(log, epoch))
    versions.remove_old(spark, log, keep=3)


def _epoch(spark: SparkSession, log: str) -> int:
    return max(versions.numbers(spark, log), default=0)


def _folder(log: str, epoch: int) -> str:
    return f"{log}/events/e={epoch}"


def _write(spark: SparkSession, folder: str, event_id: str, line: str) -> None:
    """A file that appears with its content, under a name that no other event has."""
    fs, draft = hadoop_path(spark, f"{folder}/_{event_id}")
    _, target = hadoop_path(spark, f"{folder}/{event_id}.json")
    out = fs.create(draft, True)
    out.write(bytearray(line.encode()))
    out.close()
    fs.rename(draft, target)


def _shown(value: str | int | bool | date | datetime) -> str | int | bool:
    if isinstance(value, datetime):
        return value.isoformat(timespec="microseconds")
    return value.isoformat() if isinstance(value, date) else value
