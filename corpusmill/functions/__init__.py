"""Column functions: pure expressions that stay inside Spark's generated code."""
