"""Sinks: writers for records."""
