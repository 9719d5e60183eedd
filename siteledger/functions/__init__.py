"""Column expressions: text, URL, HTML and message helpers."""
