"""Column expressions: lexing, n-gram keys, reproducible sampling keys."""
