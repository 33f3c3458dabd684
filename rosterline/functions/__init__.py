"""Column expressions used by every operator (all built-in Spark functions)."""
