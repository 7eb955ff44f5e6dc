"""Scalar operators: every function takes and returns Spark columns."""
