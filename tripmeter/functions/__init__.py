"""Column expressions: plain built-in functions, no UDF anywhere."""
