"""Column functions: text, numbers, geography, similarity."""
