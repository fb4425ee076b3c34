"""Incremental preparation of newly arrived files."""
