from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException

from shelfline import schemas
from shelfline.config import EngineConfig
from shelfline.sources import jdbc
from shelfline.sources.files import scan_or_empty, scan_set


def test_absent_set_is_empty_or_an_error(spark, tmp_path):
    path = str(tmp_path / "nowhere")
    df = scan_or_empty(spark, path, schemas.RAW["sales"])
    assert df.count() == 0 and "transaction_id" in df.columns
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        scan_set(spark, path, schemas.RAW["sales"])


def test_connection_options_come_from_the_environment():
    options = jdbc.mysql_options({"MYSQL_HOST": "db", "MYSQL_USER": "u", "MYSQL_PASSWORD": "p"})
    assert options["url"] == "jdbc:mysql://db:3306/inventory_wms"
    assert (options["user"], options["password"]) == ("u", "p")
    bare = jdbc.postgres_options({"PG_PORT": "5433", "PG_DATABASE": "dw"})
    assert bare["url"] == "jdbc:postgresql://localhost:5433/dw"
    assert "user" not in bare and "password" not in bare


def test_stock_predicates_are_disjoint_and_complete():
    predicates = jdbc.stock_predicates(date(2026, 6, 1), date(2026, 6, 3), 2)
    assert len(predicates) == 6
    assert predicates[0] == (
        "created_date >= '2026-06-01' AND created_date < '2026-06-02' AND MOD(ABS(product_id), 2) = 0"
    )
    assert predicates[-1] == "created_date >= '2026-06-03' AND MOD(ABS(product_id), 2) = 1"
    assert len(jdbc.stock_predicates(date(2026, 6, 5), date(2026, 6, 3), 2)) == 2
    year = jdbc.stock_predicates(date(2025, 1, 1), date(2026, 1, 1), 4, days_per_scan=15)
    assert len(year) == 100
    spans = [p.split(" AND MOD")[0] for p in year[::4]]
    assert spans[0].startswith("created_date >= '2025-01-01'") and "<" not in spans[-1]
    assert all(a.split("'")[3] == b.split("'")[1] for a, b in zip(spans, spans[1:]))


def test_pushed_queries_state_the_watermark():
    where = jdbc.since_clause("transaction_date", date(2026, 6, 1))
    assert jdbc.bounds_query("sales_transaction", "transaction_id", where) == (
        "SELECT MIN(transaction_id) AS low, MAX(transaction_id) AS high FROM sales_transaction"
        " WHERE transaction_date >= '2026-06-01'"
    )
    assert "d.received_date >= '2026-06-01'" in jdbc.purchases_query(date(2026, 6, 1))


def test_settings():
    config = EngineConfig.from_env("/base", datetime(2026, 6, 2, 6), {"INVENTORY_LEAD_TIME_DAYS": "9"})
    assert (config.lead_time_days, config.safety_stock_days, config.raw_dir) == (9, 3, "/base/data/raw")
    assert config.next_watermark == date(2026, 6, 1)
    assert config.read_since(date(2026, 6, 1)) == date(2026, 6, 1)
    wide = EngineConfig.under("/base", datetime(2026, 6, 2, 6), lookback_days=30)
    assert wide.read_since(date(2026, 6, 1)) == date(2026, 5, 2)
