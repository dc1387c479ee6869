"""The operators on unbounded tables."""
