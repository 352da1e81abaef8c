"""Monthly retail event analytics as Spark DataFrame operators."""
