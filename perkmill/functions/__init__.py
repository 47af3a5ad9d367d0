"""Column-returning functions: every one is built from Spark's own expressions."""
