"""Column expressions: hashing, text and distances."""
