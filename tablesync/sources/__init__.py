"""Readers for relational sources, lake tables and landed JSON."""

from tablesync.sources.registry import SourceSpec, load_specs, open_source

__all__ = ["SourceSpec", "load_specs", "open_source"]
