"""Column expressions: cleaning, name parsing, ratios, labels, paths."""
