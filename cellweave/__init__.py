"""Long-read single-cell analytics as Spark DataFrame operators."""
