"""Column functions: text, numbers and units, dates, hashes."""
