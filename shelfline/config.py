"""Run settings. One immutable object is passed to every stage; nothing reads the clock or the environment later."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta

# Defaults every deployment starts from.
DEFAULT_PIPELINE_NAME = "retail_inventory_pipeline"
DEFAULT_LEAD_TIME_DAYS = 5
DEFAULT_SAFETY_STOCK_DAYS = 3
FIRST_RUN_WINDOW_DAYS = 30


@dataclass(frozen=True)
class EngineConfig:
    raw_dir: str
    staging_dir: str
    mart_dir: str
    warehouse_dir: str
    as_of: datetime
    lead_time_days: int = DEFAULT_LEAD_TIME_DAYS
    safety_stock_days: int = DEFAULT_SAFETY_STOCK_DAYS
    # Days read before the watermark so that opening stock and the rolling frames see history.
    # 0 gives the clipped history of a plain incremental run.
    lookback_days: int = 0
    # Carry each product's last ledger rows from run to run: the same figures as with all history, without reading it.
    carry_state: bool = False
    pipeline_name: str = DEFAULT_PIPELINE_NAME
    # Movement references per warehouse partition: bounds what one upsert has to rewrite.
    movement_bucket_span: int = 1 << 24
    # Parts of the product dimension: a load writes those anew in which a product has changed.
    product_buckets: int = 16

    @classmethod
    def under(cls, base_dir: str, as_of: datetime, **settings) -> EngineConfig:
        """All four layers below one shared folder."""
        base = base_dir.rstrip("/")
        return cls(f"{base}/raw", f"{base}/staging", f"{base}/mart", f"{base}/warehouse", as_of, **settings)

    @classmethod
    def from_env(cls, base_dir: str, as_of: datetime, env: Mapping[str, str] = os.environ) -> EngineConfig:
        base = base_dir.rstrip("/")
        return cls(
            raw_dir=f"{base}/{env.get('DATA_RAW_DIR', 'data/raw')}",
            staging_dir=f"{base}/{env.get('DATA_STAGING_DIR', 'data/staging')}",
            mart_dir=f"{base}/{env.get('DATA_MART_DIR', 'data/mart')}",
            warehouse_dir=f"{base}/{env.get('DATA_WAREHOUSE_DIR', 'data/warehouse')}",
            as_of=as_of,
            lead_time_days=int(env.get("INVENTORY_LEAD_TIME_DAYS", DEFAULT_LEAD_TIME_DAYS)),
            safety_stock_days=int(env.get("INVENTORY_SAFETY_STOCK_DAYS", DEFAULT_SAFETY_STOCK_DAYS)),
        )

    def __post_init__(self) -> None:
        if self.carry_state and self.lookback_days:
            raise ValueError("carry_state and lookback_days are two ways to the same history: choose one")

    def read_since(self, watermark: date) -> date:
        return watermark - timedelta(days=self.lookback_days)

    @property
    def next_watermark(self) -> date:
        """The day before the run, whatever the data holds; that day is read again next time."""
        return self.as_of.date() - timedelta(days=1)
