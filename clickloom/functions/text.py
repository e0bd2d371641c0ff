from __future__ import annotations

from pyspark.sql import Column, functions as F


def normalize_gpn(*candidates: Column) -> Column:
    """First non-null candidate, a trailing ``.0`` removed, zero-padded (or cut) to 8 characters."""
    first = F.coalesce(*(c.cast("string") for c in candidates))
    return F.lpad(F.regexp_replace(first, r"\.0$", ""), 8, "0")


def or_empty(value: Column) -> Column:
    """NULL as the empty string, so that NULL and '' fall into one group."""
    return F.coalesce(value.cast("string"), F.lit(""))


def is_filled(value: Column) -> Column:
    return value.isNotNull() & (value != "")


def thousands(number: Column) -> Column:
    """Whole number with apostrophes between groups of three digits."""
    return F.translate(F.format_number(number, 0), ",", "'")


def link_host(address: Column) -> Column:
    """Host part of an http(s) address, '' when there is none."""
    return F.regexp_extract(address, r"https?://([^/]+)", 1)


def settled(value: Column, digits: int) -> Column:
    """Half-up rounding that does not depend on the order in which a sum of doubles was added.

    The last binary digits of such a sum vary between runs; they are rounded away first, so that a value
    like 16.225 goes the same way every time.
    """
    return F.round(F.round(value, 9), digits)
