"""Parquet sinks: whole sets, and what a change of a partitioned table has to read."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window, functions as F

#: Ranges of partitions that the scan of a merge's target is pruned to.
RANGES = 8


def write_observed(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    measures: dict[str, Column] | None = None,
    mode: str = "overwrite",
    rebalance: bool = True,
) -> dict[str, int]:
    """Write a Parquet set; returns its row count (`rows`) and further measures, observed while writing.

    They are taken in the last stage, where a task that runs again is counted once.

    Partitioned sets are rebalanced first: rows of one partition meet in few tasks, while AQE splits a
    partition that is large and merges those that are small. Inside the files rows lie in key order, so
    that min/max statistics prune. Without `rebalance`, rows are written by the tasks that have them, which suits rows that come
    from a scan of such a set: scans pack small files, so files don't grow in number from one change to the next.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    observed = Observation()
    named = [measure.alias(name) for name, measure in (measures or {}).items()]
    df = df.observe(observed, F.count(F.lit(1)).alias("rows"), *named)
    order = [*partition_by, *cluster_by]
    if order:
        df = df.sortWithinPartitions(*order)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return observed.get


def write_set(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (), mode: str = "overwrite"
) -> int:
    """Write a Parquet set and return its row count."""
    return write_observed(df, path, partition_by, cluster_by, mode=mode)["rows"]


def touched_ranges(rows: DataFrame, partition_by: Sequence[str], most: int = RANGES) -> list[Row]:
    """Ranges (_low, _high) of the last partition column that `rows` falls into, under each value of the outer ones.

    The distinct values form islands: they are split at their `most` - 1 widest gaps, so a late row makes a range of its
    own instead of widening that of the others. Only distinct partition values meet in a window, and at most `most`
    ranges for each outer value, which are few by the layout (three movement types, or none), reach the driver.
    """
    *outer, last = partition_by
    number = F.unix_date(last) if dict(rows.dtypes)[last] == "date" else F.col(last)
    by_value = Window.partitionBy(*outer).orderBy(last)
    by_gap = Window.partitionBy(*outer).orderBy(F.desc_nulls_last("_gap"), last)
    values = rows.select(*partition_by).distinct().withColumn("_gap", number - F.lag(number).over(by_value))
    starts = (F.row_number().over(by_gap) < most) & (F.col("_gap") > 1)
    islands = values.withColumn("_starts", F.coalesce(starts.cast("int"), F.lit(0)))
    islands = islands.withColumn("_island", F.sum("_starts").over(by_value))
    return islands.groupBy(*outer, "_island").agg(F.min(last).alias("_low"), F.max(last).alias("_high")).collect()


def touched_partitions(table: DataFrame, rows: DataFrame, partition_by: Sequence[str], most: int = RANGES) -> DataFrame:
    """The rows of a table that lie in the partitions which `rows` falls into.

    The scan is pruned to the ranges of the touched values; a semi join on the distinct values does the rest, so the
    result is the same however many ranges there are.
    """
    *outer, last = partition_by
    wanted = F.lit(False)
    for span in touched_ranges(rows, partition_by, most):
        inside = F.col(last).between(F.lit(span["_low"]), F.lit(span["_high"]))
        wanted = wanted | reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(span[c])) for c in outer], inside)
    return table.filter(wanted).join(rows.select(*partition_by).distinct(), list(partition_by), "left_semi")


def create_marker(spark: SparkSession, path: str) -> None:
    """An empty file: one step on any file system."""
    fs, file = hadoop_path(spark, path)
    fs.create(file, True).close()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder or file, if it is there."""
    fs, folder = hadoop_path(spark, path)
    fs.delete(folder, True)


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def shared_folder(spark: SparkSession) -> str:
    """A new folder name that every executor can reach: below spark.checkpoint.dir, or else below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"

