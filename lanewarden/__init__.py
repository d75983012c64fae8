"""Average-speed enforcement analytics as Spark DataFrame operators."""
