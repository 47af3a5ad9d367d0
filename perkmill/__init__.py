"""Employee benefit analytics as composable Spark DataFrame functions."""
