"""Column expressions: safe casts, defect flags and hash selection."""
