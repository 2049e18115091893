"""Streaming forms of the operators, fed by files as they land."""
