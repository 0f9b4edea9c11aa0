"""Column functions: text, dates, records, HTML."""
