"""Comparing and joining independent sources, loudly when they disagree."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import chronological


class ReconciliationError(Exception):
    """Names of one source have no counterpart in the other."""


class AlignmentError(Exception):
    """Two sources that must pair up one to one do not."""


SHOWN = 20


def differences(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    left_prefix: str = "computed",
    right_prefix: str = "official",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows where two sources differ: a key missing on one side or unequal values.

    ``carry`` columns exist on both sides and are only shown. NULL against a value does not
    count as a difference, as in SQL.
    """
    pairs = F.lit(True)
    for k in keys:
        pairs = pairs & (F.col(f"l.{k}") == F.col(f"r.{k}"))
    unequal = F.col("l._here").isNull() | F.col("r._here").isNull()
    for c in compare:
        unequal = unequal | (F.col(f"l.{c}") != F.col(f"r.{c}"))
    both = (
        left.withColumn("_here", F.lit(1)).alias("l")
        .join(right.withColumn("_here", F.lit(1)).alias("r"), pairs, "full_outer")
    )
    return both.where(unequal).select(
        *[F.coalesce(f"l.{c}", f"r.{c}").alias(c) for c in [*keys, *carry]],
        *[
            F.col(f"{side}.{c}").alias(f"{prefix}_{c}")
            for c in compare
            for side, prefix in (("l", left_prefix), ("r", right_prefix))
        ],
    )


def with_canonical_name(
    df: DataFrame, name: str, aliases: Mapping[str, str] | DataFrame, out: str
) -> DataFrame:
    """Source spelling to canonical spelling; names without an alias stay as they are.

    A small fixed mapping becomes a map literal; a (source_name, canonical_name) table is
    joined, and Spark broadcasts it only while it is small.
    """
    if isinstance(aliases, DataFrame):
        table = aliases.select(
            F.col("source_name").alias("_source"), F.col("canonical_name").alias("_canonical")
        )
        return (
            df.join(table, F.col(name) == F.col("_source"), "left")
            .withColumn(out, F.coalesce("_canonical", name))
            .drop("_source", "_canonical")
        )
    if not aliases:
        return df.withColumn(out, F.col(name))
    literal = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return df.withColumn(out, F.coalesce(F.try_element_at(literal, F.col(name)), F.col(name)))


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have.

    Both sides are reduced to distinct keys first, so a frequent key is shuffled once per task.
    """
    wanted, known = left.select(*keys).distinct(), right.select(*keys).distinct()
    return wanted.join(known, list(keys), "left_anti")


def unmatched_both_ways(
    left: DataFrame, right: DataFrame, keys: Sequence[str], names: tuple[str, str]
) -> DataFrame:
    """Keys present in exactly one source, with the side that has them."""
    only_left = unmatched(left, right, keys).withColumn("only_in", F.lit(names[0]))
    only_right = unmatched(right, left, keys).withColumn("only_in", F.lit(names[1]))
    return only_left.unionByName(only_right)


def require_matched(left: DataFrame, right: DataFrame, key: str, label: str) -> None:
    """Raise with the sorted unmatched names (the message shows a bounded number)."""
    missing = unmatched(left, right, [key])
    shown = [r[0] for r in missing.orderBy(key).take(SHOWN + 1)]
    if shown:
        tail = ", …" if len(shown) > SHOWN else ""
        raise ReconciliationError(
            f"{label}: no counterpart for {', '.join(map(repr, shown[:SHOWN]))}{tail}"
        )


def merge_one_to_one(tables: Sequence[DataFrame], key: str, missing: str = "raise") -> DataFrame:
    """Merge tables that must each hold a key at most once.

    A key that is missing in some table raises, or with ``missing="keep"`` stays with NULLs.
    """
    for i, table in enumerate(tables):
        twice = table.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").take(1)
        if twice:
            raise AlignmentError(f"table {i}: {key}={twice[0][0]!r} occurs more than once")
    if missing == "raise":
        seen = reduce(lambda a, b: a.unionByName(b), [t.select(key, F.lit(i).alias("_table")) for i, t in enumerate(tables)])
        lone = seen.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < len(tables)).orderBy(key).take(SHOWN)
        if lone:
            raise AlignmentError(f"{key} not in every table: {', '.join(repr(r[0]) for r in lone)}")
    return reduce(lambda a, b: a.join(b, key, "full_outer"), tables)


def paired_by_order(
    left: DataFrame,
    right: DataFrame,
    entity: Sequence[str],
    left_order: Sequence[Column],
    right_order: Sequence[Column],
    prefixes: tuple[str, str] = ("left", "right"),
) -> DataFrame:
    """n-th event of an entity in one source beside its n-th event in the other.

    The sources share no ids, only the chronology. An entity whose counts differ shows rows
    with NULL on one side; ``require_paired`` turns those into an error.
    """
    sides = []
    for df, order, prefix in (
        (left, left_order, prefixes[0]),
        (right, right_order, prefixes[1]),
    ):
        numbered = chronological(df, entity, order).withColumn("has", F.lit(True))
        values = [c for c in numbered.columns if c not in (*entity, "step")]
        sides.append(
            numbered.select(*entity, "step", *[F.col(c).alias(f"{prefix}_{c}") for c in values])
        )
    return sides[0].join(sides[1], [*entity, "step"], "full_outer")


def require_paired(paired: DataFrame, prefixes: tuple[str, str] = ("left", "right")) -> DataFrame:
    """Pass rows through; the job fails at the first event without a counterpart."""
    complete = F.col(f"{prefixes[0]}_has") & F.col(f"{prefixes[1]}_has")
    ok = F.coalesce(complete, F.lit(False))
    lone = paired.where(~ok).take(1)
    if lone:
        raise AlignmentError(f"sources differ in length: {lone[0].asDict()}")
    return paired.drop(*[f"{p}_has" for p in prefixes])
