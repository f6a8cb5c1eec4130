"""tillstack: point-of-sale analytics on Spark."""
