"""Spark operators for procurement warehouses, data-quality checks and vehicle-position streams."""
