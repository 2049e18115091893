"""Column functions: text readings, ratios and JSON."""
