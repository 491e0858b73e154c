"""Event analytics on Spark: bronze, silver and gold tables for JSON event streams."""
