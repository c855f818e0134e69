"""Column functions: pure expressions, no shuffle and no Python workers."""
