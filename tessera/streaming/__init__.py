"""The same votes on streams."""
