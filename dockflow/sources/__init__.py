"""Readers, payload parsers and table sinks."""
