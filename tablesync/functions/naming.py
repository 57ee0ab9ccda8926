"""Identifier quoting and target names."""

from __future__ import annotations

from urllib.parse import quote_plus

_QUOTE_CHAR = {"postgres": '"', "oracle": '"', "mysql": "`", "spark": "`"}


def quote(kind: str, identifier: str) -> str:
    """Quote one identifier in the source's dialect, doubling embedded quote characters."""
    mark = _QUOTE_CHAR[kind]
    return mark + identifier.replace(mark, mark * 2) + mark


def qualified(kind: str, *parts: str) -> str:
    return ".".join(quote(kind, p) for p in parts if p)


def text_literal(value: str) -> str:
    """A single-quoted SQL text literal."""
    return "'" + value.replace("'", "''") + "'"


def target_name(source_name: str, table_name: str) -> str:
    """Name of a table in the target when several sources share one schema."""
    return f"{source_name}_{table_name}"


def path_safe(text: str) -> str:
    """Text for use in a path: run ids often hold times, and some stores refuse colons."""
    return quote_plus(text, safe="").replace("%", "_")
