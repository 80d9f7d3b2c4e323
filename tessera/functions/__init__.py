"""Column expressions: geometry, plate text, hashing and sampling."""
