"""Column functions: labels, codes, identifiers and wall-clock arithmetic."""
