"""Column expressions: calendar steps, missing values, metrics."""
