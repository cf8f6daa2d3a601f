"""Parsing and normalising of text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def group_code(raw: str | Column) -> Column:
    """One canonical code for ``GROUP_A`` and ``Group A``."""
    c = F.col(raw) if isinstance(raw, str) else raw
    return F.replace(F.replace(c, F.lit("GROUP_"), F.lit("")), F.lit("Group "), F.lit(""))


def number_with_unit(raw: str | Column) -> Column:
    """Number inside ``67%`` or ``12 km``; anything unparsable becomes NULL."""
    c = F.col(raw) if isinstance(raw, str) else raw
    bare = F.replace(F.replace(c.cast("string"), F.lit("%"), F.lit("")), F.lit(" km"), F.lit(""))
    return F.trim(bare).try_cast("double")


def utc_wall_time(raw: str | Column) -> Column:
    """ISO-8601 text to a zone-less UTC timestamp; malformed text raises under ANSI."""
    c = F.col(raw) if isinstance(raw, str) else raw
    return c.cast("timestamp_ntz")


def same_name(name: str | Column, subject: str) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    return F.lower(F.coalesce(c, F.lit(""))) == F.lit(subject.lower())
