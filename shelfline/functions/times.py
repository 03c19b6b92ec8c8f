"""Time literals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def wall_clock(moment: datetime) -> Column:
    """A moment as TIMESTAMP_NTZ, as it reads: no zone of the client or the session shifts it."""
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
