"""Names and literals inside SQL expression text.

Wide tables mean long generated projections; as SQL text they reach the
analyzer in one piece instead of one call per operator.
"""

from __future__ import annotations


def ident(name: str) -> str:
    """A column name, quoted."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
