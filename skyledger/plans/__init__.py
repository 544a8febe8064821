"""Whole jobs: element refresh, catalogue refresh and monitoring."""
