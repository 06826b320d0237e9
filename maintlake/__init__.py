"""Maintenance lakehouse on Spark: CDC resolution, concept mapping, rollups and a query facade."""
