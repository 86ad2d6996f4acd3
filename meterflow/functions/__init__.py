"""Column expressions; all of them are built-in Spark expressions."""
