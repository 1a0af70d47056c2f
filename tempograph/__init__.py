"""Timeline analytics on Spark."""
