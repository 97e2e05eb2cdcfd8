"""Column functions: text, dates and identifiers."""
