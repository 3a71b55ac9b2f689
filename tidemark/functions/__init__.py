"""Column expressions: casts, geography, calendar and masking."""
