"""Column expressions and column-group helpers."""
