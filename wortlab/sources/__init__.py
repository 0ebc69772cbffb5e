"""Readers, writers and stand-in views over the driver tables."""
