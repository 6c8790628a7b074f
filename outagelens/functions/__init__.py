"""Column builders: every function takes and returns ``Column`` values."""
