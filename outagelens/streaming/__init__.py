"""The row-level work applied to files as they land."""
