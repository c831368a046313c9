"""Column expressions: no Spark action and no Python row code."""
