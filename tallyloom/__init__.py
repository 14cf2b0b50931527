"""Monthly quality-measure analytics as composable Spark DataFrame operators."""
