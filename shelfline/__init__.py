"""Inventory analytics on Spark: stock ledger, rolling metrics, reorder advice, gated marts and a star-schema load."""
