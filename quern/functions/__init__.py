"""Column expressions: dates, tokens, regions, hashed features."""
