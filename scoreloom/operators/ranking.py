"""Latest-per-key, top-k and row numbering that hold up when one key is hot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import materialise


def newest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def oldest_first(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key by ``order``, which must be total within a key.

    Spark plans a group limit on both sides of the shuffle, so each task sends at most one
    row per key and a hot key stays cheap.
    """
    window = W.partitionBy(*keys).orderBy(*newest_first(*order))
    return df.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


def as_of(df: DataFrame, day: Column, on: str = "extraction_date") -> DataFrame:
    """Snapshots up to ``day``; on a partition column this prunes the scan."""
    return df.where(F.col(on) <= day)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_k_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, out: str = "rank"
) -> DataFrame:
    """First ``k`` rows of every key; at most k rows per key and task are shuffled."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= k)


def ranked(
    df: DataFrame, order: Sequence[Column], out: str = "rank", by: Sequence[str] = ()
) -> DataFrame:
    """1-based row number by ``order`` within ``by``, for groups of any size.

    A window would put a whole group (or, without keys, everything) into one task. Here one
    global sort spreads every group over many tasks; the sorted rows are checkpointed with
    their place in the partition, and only the number of rows per (partition, group) is
    summed to shift the places. ``order`` must be total within a group: equal keys cannot
    be split.
    """
    by = list(by)
    placed = materialise(
        df.orderBy(*[F.col(c).asc_nulls_last() for c in by], *order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_at", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_id")
    )
    # at most one row per task and group; a group's rows here are bounded by the task count
    pieces = placed.groupBy("_part", *by).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first")
    )
    earlier = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.select(
        F.col("_part").alias("_p"),
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)],
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(pieces, same).select(
        *[F.col(c) for c in df.columns], (F.col("_at") + F.col("_shift")).alias(out)
    )


def chronological(
    df: DataFrame, entity: Sequence[str], order: Sequence[Column], out: str = "step"
) -> DataFrame:
    """Sequence number of every event of an entity; an entity may hold most of the rows."""
    return ranked(df, order, out, by=entity)


def lagged(df: DataFrame, order: Sequence[Column], values: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Rows with values of the row before them within ``by``, new name -> column, for groups of any size.

    Rows are numbered over the cluster and meet their predecessor by number, so no task holds a group.
    ``order`` must be total within a group; the first row of a group has NULLs.
    """
    by = list(by)
    numbered = materialise(ranked(df, order, "_n", by))
    before = numbered.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], (F.col("_n") + 1).alias("_before"), *[F.col(c).alias(new) for new, c in values.items()])
    same = F.col("_n") == F.col("_before")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return numbered.join(before, same, "left").select(*df.columns, *values)
