"""Column expressions and measure lists."""
