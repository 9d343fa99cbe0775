"""Column expressions and the model registry."""
