"""Queries over the given tables with an equivalent SQL text for each."""
