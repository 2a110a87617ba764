"""Column expressions: reproducible randomness, name rules, metrics."""
