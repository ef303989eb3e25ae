"""Names and text inside SQL."""

from __future__ import annotations


def name_sql(name: str) -> str:
    """One identifier, quoted."""
    return "`" + name.replace("`", "``") + "`"


def text_sql(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
