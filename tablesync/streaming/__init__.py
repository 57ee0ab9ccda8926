"""Sync as a stream of change files."""
