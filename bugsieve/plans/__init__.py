"""Composed plans: staging frame in, normalized records out."""
