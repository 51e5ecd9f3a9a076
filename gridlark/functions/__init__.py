"""A1 references, globs, number formats, inference and casts."""
