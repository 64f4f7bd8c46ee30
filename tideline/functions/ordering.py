"""Ordering of arbitrarily large decimal integers carried as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sequence_order(c: Column | str) -> list[Column]:
    """Sort columns of a non-negative integer in text: digits, then text, without leading zeros."""
    text = F.ltrim(_col(c), F.lit("0"))
    return [F.length(text).alias("digits"), text.alias("text")]


def sequence_key(c: Column | str) -> Column:
    """The same as one comparable value, for aggregates and comparisons; null stays null.

    Sorts are cheaper on the separate columns of ``sequence_order``.
    """
    return F.when(_col(c).isNotNull(), F.struct(*sequence_order(c)))


def is_number(c: Column | str) -> Column:
    """True when the text is a plain integer, as opposed to a sentinel."""
    return _col(c).rlike("^[0-9]+$")
