"""Candle analytics on Spark: storage views, quality checks, features, windows and streams."""
