"""Panel-survey analytics as Spark DataFrame operators."""
