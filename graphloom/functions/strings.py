"""Text functions. Positions count from 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def size(text: Column) -> Column:
    return F.length(text).cast("long")


def concat(left: Column, right: Column) -> Column:
    """`+` on two texts, or a text and a number."""
    return F.concat(left.cast("string"), right.cast("string"))


def trim(text: Column) -> Column:
    return F.trim(text)


def ltrim(text: Column) -> Column:
    return F.ltrim(text)


def rtrim(text: Column) -> Column:
    return F.rtrim(text)


def to_upper(text: Column) -> Column:
    return F.upper(text)


def to_lower(text: Column) -> Column:
    return F.lower(text)


def replace(text: Column, search: Column, replacement: Column) -> Column:
    """Every occurrence of `search` as a whole."""
    return F.replace(text, search, replacement)


def translate(text: Column, matching: str, replacement: str) -> Column:
    """Character by character: the n-th of `matching` becomes the n-th of `replacement`, or goes."""
    return F.translate(text, matching, replacement)


def substring(text: Column, start: Column, length: Column | None = None) -> Column:
    rest = F.length(text) - start
    return F.substr(text, start + F.lit(1), rest if length is None else length)
