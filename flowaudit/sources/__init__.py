"""Readers, writers and typed tables."""
