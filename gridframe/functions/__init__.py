"""Column expressions: names, addresses, cell text and links."""
