"""Explicit schemas (Spark DDL) of every stored set. Quantities are summed as BIGINT, money as DECIMAL."""

# Source tables.
SOURCE = {
    "product": (
        "product_id INT, code STRING, name STRING, category STRING, barcode STRING,"
        " weight DECIMAL(10,2), is_active BOOLEAN, created_at TIMESTAMP_NTZ"
    ),
    "supplier": (
        "supplier_id INT, code STRING, name STRING, email STRING, country STRING, created_at TIMESTAMP_NTZ"
    ),
    "purchase_order_header": (
        "po_header_id BIGINT, po_number STRING, supplier_id INT, order_date DATE, status STRING,"
        " created_at TIMESTAMP_NTZ"
    ),
    "purchase_order_detail": (
        "po_detail_id BIGINT, po_header_id BIGINT, product_id INT, quantity INT, unit_price DECIMAL(12,2),"
        " received_quantity INT, received_date TIMESTAMP_NTZ"
    ),
    "sales_transaction": (
        "transaction_id BIGINT, transaction_number STRING, transaction_date TIMESTAMP_NTZ, product_id INT,"
        " quantity INT, unit_price DECIMAL(12,2), discount DECIMAL(5,2), total_amount DECIMAL(12,2),"
        " created_at TIMESTAMP_NTZ"
    ),
    "stock_adjustment": (
        "adjustment_id BIGINT, adjustment_number STRING, adjustment_date TIMESTAMP_NTZ, product_id INT,"
        " quantity INT, reason STRING, created_at TIMESTAMP_NTZ"
    ),
    "stock_daily": "product_id INT, location_code STRING, onhand_quantity INT, created_date TIMESTAMP_NTZ",
}

# Raw sets: what the extract stage stores.
RAW = {
    "products": SOURCE["product"],
    "suppliers": SOURCE["supplier"],
    "sales": SOURCE["sales_transaction"],
    "purchases": (
        "po_detail_id BIGINT, po_header_id BIGINT, po_number STRING, supplier_id INT, order_date DATE,"
        " product_id INT, quantity INT, unit_price DECIMAL(12,2), received_quantity INT,"
        " received_date TIMESTAMP_NTZ"
    ),
    "adjustments": SOURCE["stock_adjustment"],
    "stock_daily": SOURCE["stock_daily"],
}

LEDGER = (
    "inventory_date DATE, product_id INT, stock_awal BIGINT, quantity_received BIGINT, quantity_sold BIGINT,"
    " quantity_adjusted BIGINT, stock_akhir BIGINT, stock_aktual_system BIGINT, selisih BIGINT"
)

_ADVICE = (
    f"{LEDGER}, daily_sales_velocity DOUBLE, days_of_inventory DOUBLE, inventory_turnover_rate DOUBLE,"
    " sales_speed_class STRING, reorder_alert BOOLEAN, recommended_reorder_qty INT"
)

_MOVEMENT = (
    "movement_date DATE, product_id INT, supplier_id INT, movement_type STRING, quantity INT,"
    " unit_price DECIMAL(12,2), total_amount DECIMAL(12,2), source_reference_id BIGINT"
)

STAGING = {
    "reorder_recommendation": _ADVICE,
    "ledger_state": LEDGER,
    "product_changes": (
        "product_id INT, product_code STRING, product_name STRING, category STRING, barcode STRING,"
        " weight DECIMAL(10,2), is_active BOOLEAN, old_sk BIGINT, action STRING"
    ),
}

MART = {
    "fact_daily_inventory": _ADVICE,
    "fact_inventory_movement": _MOVEMENT,
    "reorder_recommendations": _ADVICE,
}

WAREHOUSE = {
    "dim_supplier": (
        "supplier_id INT, supplier_code STRING, supplier_name STRING, email STRING, country STRING,"
        " created_at TIMESTAMP_NTZ, ingestion_date TIMESTAMP_NTZ"
    ),
    "dim_product": (
        "product_sk BIGINT, product_id INT, product_code STRING, product_name STRING, category STRING,"
        " barcode STRING, weight DECIMAL(10,2), is_active BOOLEAN, effective_start_date TIMESTAMP_NTZ,"
        " effective_end_date TIMESTAMP_NTZ, is_current BOOLEAN, created_at TIMESTAMP_NTZ, row_digest BIGINT,"
        " end_day DATE, product_bucket INT"
    ),
    "fact_inventory_movement": f"movement_id BIGINT, {_MOVEMENT}, ingestion_date TIMESTAMP_NTZ, ref_bucket BIGINT",
    "fact_daily_inventory": (
        "id BIGINT, inventory_date DATE, product_id INT, stock_awal INT, quantity_received INT,"
        " quantity_sold INT, quantity_adjusted INT, stock_akhir INT, stock_aktual_system INT, selisih INT,"
        " daily_sales_velocity DECIMAL(10,2), days_of_inventory DECIMAL(10,2),"
        " inventory_turnover_rate DECIMAL(10,2), sales_speed_class STRING, reorder_alert BOOLEAN,"
        " recommended_reorder_qty INT, ingestion_date TIMESTAMP_NTZ"
    ),
    "etl_state": "pipeline_name STRING, last_success_date DATE, updated_at TIMESTAMP_NTZ",
    # One row per event; views fold them to one row per run, per set of a run, or per watermark.
    "etl_log": (
        "event_id STRING, kind STRING, event_time TIMESTAMP_NTZ, run_id BIGINT, pipeline_name STRING,"
        " run_status STRING, is_closing BOOLEAN, records_extracted BIGINT, records_loaded BIGINT,"
        " dq_checks_passed INT, dq_checks_failed INT, error_message STRING,"
        " set_name STRING, set_version BIGINT, set_rows BIGINT, verdict STRING,"
        " last_success_date DATE, updated_at TIMESTAMP_NTZ"
    ),
}
