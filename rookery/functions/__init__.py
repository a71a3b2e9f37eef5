"""Column functions: text patterns, URLs, HTML, addresses, rules."""
