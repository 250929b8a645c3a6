"""Waybill: delivery analytics as Spark DataFrame, SQL and Structured Streaming plans."""
