"""Column functions: keys, scoring, text, vectors and model hooks."""
