"""Column expressions: dates and seasons, payload fields, ratios."""
