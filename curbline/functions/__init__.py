"""Column expressions: text, clock, identity and ratio helpers."""
