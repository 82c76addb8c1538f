"""arborlex."""
