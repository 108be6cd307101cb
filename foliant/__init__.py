"""Document-corpus analytics expressed as Spark DataFrame operations."""
