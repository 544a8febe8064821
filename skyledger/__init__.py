"""Catalogue refinement and quality gating on Spark."""
