"""Column expressions and pure helpers: types, names, tolerant casts, flags, status labels."""
