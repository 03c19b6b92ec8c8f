"""Independent Spark jobs of one stage, submitted side by side so that small ones fill the gaps of large ones."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def run_together(spark: SparkSession, jobs: dict[str, Callable[[], Result]]) -> dict[str, Result]:
    """Results by name. Every job ends before the first error, if any, is raised."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
    return {name: future.result() for name, future in futures.items()}
