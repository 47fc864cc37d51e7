"""Session recommendation analytics as Spark DataFrame operators."""
