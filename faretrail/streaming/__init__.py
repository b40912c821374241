"""streaming of the warehouse."""
