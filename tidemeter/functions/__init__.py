"""Column expressions: time, JSON payloads, text and units."""
