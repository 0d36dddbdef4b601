"""Column-level functions (pure expressions, no actions)."""
