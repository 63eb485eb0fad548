"""Column expressions built from Spark SQL functions only (no Python UDFs)."""
