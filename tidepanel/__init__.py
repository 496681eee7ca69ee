"""Cross-sectional panel analytics as Spark DataFrame operations."""
