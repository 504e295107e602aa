"""Scans of files and tables."""
