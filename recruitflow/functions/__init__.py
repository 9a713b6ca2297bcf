"""Column builders (built-in Spark expressions only) and fixed code values."""
