"""Point-in-time feature snapshots as plain Spark DataFrame operators."""
