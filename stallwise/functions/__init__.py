"""Column expressions: text cleaning, exact numbers, bands, display formats."""
