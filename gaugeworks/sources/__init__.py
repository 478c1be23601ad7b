"""Scans, canonical readings, result writers and readers."""
