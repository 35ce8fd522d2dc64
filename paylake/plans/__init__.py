"""Metric tables, their incremental rebuilds and the reports on them."""
