"""Joins of texts with small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_ITEMS = 1_000_000


def small_side(stored: DataFrame, items: str | None = None, rows: int = BROADCAST_ROWS, most_items: int = BROADCAST_ITEMS) -> DataFrame:
    """The stored table with a broadcast hint if its size, just counted, is within the bounds.

    Beyond them the join shuffles both sides, with the same result. ``items`` names an array column
    whose elements are counted too. Rows hold a few numbers, so the bounds keep it under some 50 MB.
    """
    held = F.coalesce(F.sum(F.size(items)), F.lit(0)) if items else F.lit(0)
    count, inside = stored.agg(F.count(F.lit(1)), held).first()
    return F.broadcast(stored) if count <= rows and inside <= most_items else stored


SIEVE_BITS = 24


def maybe_among(rows: DataFrame, column: str, keys: DataFrame, out: str = "_maybe") -> DataFrame:
    """The rows with a column that is false only if their 64-bit hash is not among the stored keys.

    The keys set bits of a bitmap of 2 MB, whatever their number, by the leading bits of a hash; a
    join with few partners then shuffles few rows without any.
    """
    def slot(key: str) -> Column:
        return F.shiftrightunsigned(key, 64 - SIEVE_BITS)

    def bit(key: str) -> Column:
        return F.expr(f"shiftleft(1L, cast(shiftrightunsigned({key}, {64 - SIEVE_BITS}) & 63 as int))")

    bitmap = keys.groupBy(F.shiftright(slot(column), 6).alias("_at")).agg(F.bit_or(bit(column)).alias("_bits"))
    near = rows.join(F.broadcast(bitmap), F.shiftright(slot(column), 6) == F.col("_at"), "left")
    return near.select(*rows.columns, (F.coalesce(F.col("_bits").bitwiseAND(bit(column)), F.lit(0)) != 0).alias(out))


def sieved(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows whose 64-bit hash may be among the stored keys; none that is gets lost."""
    return maybe_among(rows, column, keys).where("_maybe").drop("_maybe")
