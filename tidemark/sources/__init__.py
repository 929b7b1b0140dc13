"""Scans, report parsing and archive unpacking."""
