"""Scans, loaders and sinks."""
