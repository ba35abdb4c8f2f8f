"""String helpers whose null behaviour the operators depend on."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

# What an asset page looks like, and where its 8-character id sits.
URL_SHAPES = {
    "created": ("https://%/#databases/%/created", -16),
    "detail": ("https://%/#databases/%/detail", -15),
}


def extract_or_null(c: Column, pattern: str, group: int = 1) -> Column:
    """The captured group, or null when nothing matches (Spark alone gives '')."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def has(c: Column, *words: str) -> Column:
    """Contains any of the words; null stays null (three-valued, never false)."""
    return any_of(c.contains(w) for w in words)


def asset_id_from_url(url: Column, kind: str) -> Column:
    """The asset id in a console URL of this kind, else null."""
    shape, start = URL_SHAPES[kind]
    return F.when(url.like(shape), F.substring(url, start, 8))


def newline_count(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))


def outside_domains(email: Column, domains: Iterable[str]) -> Column:
    """E-mail mentions none of the domains; null when the e-mail is null."""
    return ~has(email, *domains)
