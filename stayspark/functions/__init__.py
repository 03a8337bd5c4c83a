"""Column expressions and the skew-safe building blocks."""
