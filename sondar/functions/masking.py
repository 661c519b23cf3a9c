"""Names that give a column away, and what a masked value shows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sondar.functions.fixed import MASK, NAME_PATTERNS, VALUE_PATTERNS
from sondar.model import SECRET


def flatten_name(name: Column) -> Column:
    """``user_email``, ``userEmail`` and ``USER-EMAIL`` come out the same."""
    split = F.regexp_replace(name, "(?<=[a-z0-9])(?=[A-Z])", "_")
    return F.regexp_replace(F.lower(split), "[^a-z0-9]+", "")


def level_from_name(name: Column) -> Column:
    """The level the name alone gives, else NULL."""
    flat = flatten_name(name)
    return F.coalesce(
        *[F.when(flat.rlike(pattern), F.lit(level)) for pattern, level in NAME_PATTERNS]
    )


def value_regexes() -> list[str]:
    """The value patterns as Java regular expressions, in order.

    White space around the value is allowed for inside the pattern, which
    saves rewriting every value before matching it.
    """
    return [
        rf"(?U)^\s*{pattern.removeprefix('^').removesuffix('$')}\s*$"
        for pattern in VALUE_PATTERNS
    ]


def mask_text(text: Column, level: str | Column) -> Column:
    """Hide a value but leave its shape: ``a***@***.com``, ``+8***78``.

    ``text`` must already be text (see ``value_text``). NULL stays NULL and a
    secret keeps nothing.
    """
    level = F.lit(level) if isinstance(level, str) else level
    mask = F.lit(MASK)
    at = F.instr(text, "@")
    domain = F.substr(text, at + 1)
    suffix = F.substring_index(domain, ".", -1)
    # Shown only if a dot has something before it.
    ending = F.when(
        domain.contains(".") & (F.length(domain) > F.length(suffix) + 1),
        F.concat(F.lit("."), suffix),
    ).otherwise(F.lit(""))
    first = F.when(at > 1, F.substring(text, 1, 1)).otherwise(F.lit(""))
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(level == SECRET, mask)
        .when(at > 0, F.concat(first, mask, F.lit("@"), mask, ending))
        .when(F.length(text) <= 4, mask)
        .otherwise(
            F.concat(F.substring(text, 1, 2), mask, F.substring(text, -2, 2))
        )
    )
