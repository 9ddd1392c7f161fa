"""Column expressions: derived measures, band ladders, fixed label values."""
