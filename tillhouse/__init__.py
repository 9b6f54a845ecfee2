"""Retail analytics on Spark: POS ingest, star schema, dashboards, stock ledger."""

__all__ = ["functions", "operators", "plans", "sinks", "sources", "streaming"]
