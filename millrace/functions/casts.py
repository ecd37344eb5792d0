"""Casts that give null on bad input whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def soft_cast(c: Column | str, kind: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(kind)


def text_to_integer(c: Column | str, kind: str = "int") -> Column:
    """Text to an integer type; a fraction is cut off, anything else that is no number gives null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.trim(c), r"(?<=[0-9])\.[0-9]*$", "").try_cast(kind)


def soft_divide(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)
