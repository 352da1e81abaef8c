"""Column expressions: text, time and month names, labels."""
