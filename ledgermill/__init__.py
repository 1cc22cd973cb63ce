"""Retail-banking analytics expressed as Spark DataFrame operators."""
