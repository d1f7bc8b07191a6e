"""Scans, text parsers and sinks."""
