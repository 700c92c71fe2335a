"""Column expressions: text, numbers, dates, keys and masks. No Python UDFs."""
