"""Column helpers for what the built-in functions do not say in one call."""
