"""Property-market analytics as ordinary Spark DataFrame jobs."""
