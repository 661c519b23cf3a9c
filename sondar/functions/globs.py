"""Shell-style name patterns as one regular expression."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _close(pattern: str, at: int) -> int:
    """Where the choice that opens at ``at`` ends, or -1. A closing bracket
    right after the opening one, or after its ``!``, is a member."""
    first = at + (2 if pattern.startswith("!", at + 1) else 1)
    return pattern.find("]", first + 1)


def _choice(body: str) -> str:
    """A choice as a character class; a range written backwards holds nothing."""
    negated = body.startswith("!")
    body = body[1:] if negated else body
    members, at = [], 0
    while at < len(body):
        low, high = body[at], body[at]
        if body[at + 1 : at + 2] == "-" and at + 2 < len(body):
            high = body[at + 2]
            at += 2
        at += 1
        if low <= high:
            members.append(f"\\x{{{ord(low):x}}}-\\x{{{ord(high):x}}}")
    if not members:
        return "." if negated else "(?!)"
    return f"[{'^' if negated else ''}{''.join(members)}]"


def glob_to_regex(pattern: str) -> str:
    """``*`` any run, ``?`` one character, ``[ab]``/``[!ab]`` a choice; the rest
    is literal. Case matters."""
    out, at = [], 0
    while at < len(pattern):
        char = pattern[at]
        close = _close(pattern, at) if char == "[" else -1
        if char == "*":
            out.append(".*")
        elif char == "?":
            out.append(".")
        elif close > 0:
            out.append(_choice(pattern[at + 1 : close]))
            at = close
        else:
            out.append(re.escape(char))
        at += 1
    return "".join(out)


def matches_any(name: Column, patterns: Iterable[str]) -> Column:
    """True where the whole name matches one of the patterns."""
    joined = "|".join(glob_to_regex(pattern) for pattern in patterns)
    return name.rlike(rf"(?s)\A(?:{joined})\z") if joined else F.lit(False)
