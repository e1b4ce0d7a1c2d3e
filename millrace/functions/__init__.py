"""Column functions: text, exact money, tokens, validation."""
