"""Column functions: text in, text or token arrays out, no Python on the row path."""
