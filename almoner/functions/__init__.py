"""Column expressions: native Spark functions only, no Python UDFs."""
