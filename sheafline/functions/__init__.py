"""Column helpers: text, MIME types, JSON payloads, identifiers and vectors."""
