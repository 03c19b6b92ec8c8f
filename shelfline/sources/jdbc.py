"""JDBC scans of the operational databases, read in parallel with pushed-down predicates."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from shelfline.sources import feeds

# Environment names and defaults of the two connections.
_CONNECTIONS = {
    "mysql": ("MYSQL", "3306", "inventory_wms", "com.mysql.cj.jdbc.Driver"),
    "postgresql": ("PG", "5432", "inventory_dw", "org.postgresql.Driver"),
}
FETCH_ROWS = "10000"


def mysql_options(env: Mapping[str, str] = os.environ) -> dict[str, str]:
    return _options("mysql", env)


def postgres_options(env: Mapping[str, str] = os.environ) -> dict[str, str]:
    return _options("postgresql", env)


def _options(kind: str, env: Mapping[str, str]) -> dict[str, str]:
    """Connection options from the environment. User and password have no default in code."""
    prefix, port, database, driver = _CONNECTIONS[kind]
    host = env.get(f"{prefix}_HOST", "localhost")
    options = {
        "url": f"jdbc:{kind}://{host}:{env.get(f'{prefix}_PORT', port)}/{env.get(f'{prefix}_DATABASE', database)}",
        "driver": driver,
        "fetchsize": FETCH_ROWS,
        "preferTimestampNTZ": "true",
    }
    for option, name in (("user", f"{prefix}_USER"), ("password", f"{prefix}_PASSWORD")):
        if name in env:
            options[option] = env[name]
    return options


def since_clause(event_column: str, since: date) -> str:
    return f"{event_column} >= '{since.isoformat()}'"


def bounds_query(table: str, id_column: str, where: str | None = None) -> str:
    condition = f" WHERE {where}" if where else ""
    return f"SELECT MIN({id_column}) AS low, MAX({id_column}) AS high FROM {table}{condition}"


def purchases_query(since: date) -> str:
    """Order lines with their headers, joined where both tables live, so that only new lines travel."""
    lines = ["po_detail_id", "po_header_id", "product_id", "quantity", "unit_price", "received_quantity"]
    chosen = ", ".join([*[f"d.{c}" for c in lines], "d.received_date", "h.po_number", "h.supplier_id", "h.order_date"])
    return (
        f"SELECT {chosen} FROM purchase_order_detail d"
        f" INNER JOIN purchase_order_header h ON h.po_header_id = d.po_header_id"
        f" WHERE {since_clause('d.received_date', since)}"
    )


def stock_predicates(since: date, until: date, product_splits: int, days_per_scan: int = 1) -> list[str]:
    """One predicate per span of log days and product remainder; the last span is open-ended.

    The log has no row id to split on. Two splits keep a partition small when one product or one day holds
    a large part of the log; rows of one product on one day are always one scan. The predicates are disjoint and cover
    every row from `since` on.
    """
    days = max((until - since).days, 0) + 1
    starts = [since + timedelta(days=offset) for offset in range(0, days, days_per_scan)]
    predicates = []
    for start, end in zip(starts, [*starts[1:], None]):
        span = since_clause("created_date", start)
        if end is not None:
            span += f" AND created_date < '{end.isoformat()}'"
        predicates += [f"{span} AND MOD(ABS(product_id), {product_splits}) = {k}" for k in range(product_splits)]
    return predicates


def scan_by_id(
    spark: SparkSession,
    options: Mapping[str, str],
    relation: str,
    id_column: str,
    partitions: int,
    columns: Sequence[str],
    where: str | None = None,
) -> DataFrame:
    """Scan in strides of a unique id between its lowest and highest wanted value.

    The bounds only place the strides: rows outside them still fall into the first or last one.
    """
    reader = spark.read.format("jdbc").options(**options)
    low, high = reader.option("query", bounds_query(relation, id_column, where)).load().first()
    scan = spark.read.format("jdbc").options(**options).option("dbtable", relation)
    if low is not None and high > low:
        scan = scan.options(
            partitionColumn=id_column, lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions)
        )
    rows = scan.load().select(*columns)
    return rows.filter(where) if where else rows


def source_tables(
    spark: SparkSession,
    since: date,
    until: date,
    mysql: Mapping[str, str] | None = None,
    postgres: Mapping[str, str] | None = None,
    partitions: int = 32,
    product_splits: int = 8,
    days_per_scan: int = 1,
) -> dict[str, DataFrame]:
    """The source tables of the extract stage, read from MySQL (trade) and PostgreSQL (stock log).

    The stock log is read in `product_splits` scans for every `days_per_scan` days of the window.
    """
    trade = mysql_options() if mysql is None else mysql
    log = postgres_options() if postgres is None else postgres

    def by_id(relation: str, id_column: str, columns: Sequence[str], where: str | None = None) -> DataFrame:
        return scan_by_id(spark, trade, relation, id_column, partitions, columns, where)

    return {
        "product": by_id("product", "product_id", feeds.PRODUCT_COLUMNS),
        "supplier": by_id("supplier", "supplier_id", feeds.SUPPLIER_COLUMNS),
        "sales_transaction": by_id(
            "sales_transaction", "transaction_id", feeds.SALES_COLUMNS, since_clause("transaction_date", since)
        ),
        "purchases": by_id(f"({purchases_query(since)}) purchases", "po_detail_id", feeds.PURCHASE_COLUMNS),
        "stock_adjustment": by_id(
            "stock_adjustment", "adjustment_id", feeds.ADJUSTMENT_COLUMNS, since_clause("adjustment_date", since)
        ),
        "stock_daily": spark.read.jdbc(
            log["url"],
            "source.stock_daily",
            predicates=stock_predicates(since, until, product_splits, days_per_scan),
            properties={k: v for k, v in log.items() if k != "url"},
        ).select(*feeds.STOCK_COLUMNS),
    }
