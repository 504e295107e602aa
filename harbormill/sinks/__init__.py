"""Writes of tables and files, and publication behind checks."""
