"""Changing the shape of rows: sides of a match, nesting, drifting unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def match_sides(
    df: DataFrame,
    home: Mapping[str, str | Column],
    away: Mapping[str, str | Column],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Two rows per match, one per side, from a single pass over the input."""

    def side(spec: Mapping[str, str | Column]) -> Column:
        return F.struct(
            *[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in spec.items()]
        )

    sides = df.select(*keep, F.explode(F.array(side(home), side(away))).alias("_side"))
    return sides.select(*keep, "_side.*")


def goal_legs(
    matches: DataFrame, keep: Sequence[str], home_goals: str, away_goals: str
) -> DataFrame:
    """Side rows with id, name, opponent and goals both ways."""
    return match_sides(
        matches,
        home={
            "team_id": "home_team_id", "team_name": "home_team_name",
            "opponent_id": "away_team_id", "scored": home_goals, "conceded": away_goals,
        },
        away={
            "team_id": "away_team_id", "team_name": "away_team_name",
            "opponent_id": "home_team_id", "scored": away_goals, "conceded": home_goals,
        },
        keep=keep,
    )


def nest_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str], out: str
) -> DataFrame:
    """Rows of a key as one ordered array, for serving documents of bounded groups.

    The array is sorted by ``order`` first, so the order columns lead each element.
    """
    lead = [c for c in order]
    rest = [c for c in fields if c not in lead]
    item = F.struct(*lead, *rest)
    shaped = F.transform(
        F.array_sort(F.collect_list(item)), lambda x: F.struct(*[x[c].alias(c) for c in fields])
    )
    return df.groupBy(*keys).agg(shaped.alias(out))


def with_group_values(df: DataFrame, values: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows beside the aggregates of their group; without keys ``values`` is a single row."""
    return df.join(values, list(by), "left") if by else df.crossJoin(values)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union of drifting layouts; a column absent on one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
