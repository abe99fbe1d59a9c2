"""Run-to-failure sensor analytics as plain Spark DataFrame operators."""
