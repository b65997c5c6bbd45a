"""Column expressions and the two row-level helpers (HTML reading, vectors)."""
