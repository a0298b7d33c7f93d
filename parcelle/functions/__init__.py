"""Column to column functions: codes, text, numbers, name similarity."""
