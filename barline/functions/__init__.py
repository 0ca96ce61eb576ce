"""Column expressions: symbols, dates, prices, keys and JSON shapes."""
