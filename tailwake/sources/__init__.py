"""Readers, writers and lookup tables."""
