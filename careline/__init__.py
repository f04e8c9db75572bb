"""Report mining and care follow-up as Spark DataFrame operations."""
