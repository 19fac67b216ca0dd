"""Column expressions and row-wise DataFrame transforms (no shuffles)."""
