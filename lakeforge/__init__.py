"""Market-data lake analytics on Spark."""
