"""Scans, sinks, names and metadata."""
