"""Column functions: text, company names, parsing, scoring and list handling."""
