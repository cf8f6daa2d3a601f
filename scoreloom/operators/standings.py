"""Ranked tables with head-to-head tie-breaks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..config import materialise
from .ranking import ranked

CRITERIA = ("points", "goal_diff", "goals_for")
COUNTS = ("played", "won", "draw", "goals_for", "goals_against")


def _null_safe(left: str, right: str, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{b}"))
    return cond


def _points() -> Column:
    return F.col("won") * V.POINTS_WIN + F.col("draw") * V.POINTS_DRAW


def pair_records(legs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Record of every team against every opponent: the only pass over the matches."""
    scored, conceded = F.col("scored"), F.col("conceded")
    return legs.groupBy(*by, "team_id", "team_name", "opponent_id").agg(
        F.count(F.lit(1)).alias("played"),
        F.count_if(scored > conceded).alias("won"),
        F.count_if(scored == conceded).alias("draw"),
        F.count_if(scored < conceded).alias("lost"),
        F.sum(scored).alias("goals_for"),
        F.sum(conceded).alias("goals_against"),
    )


def team_totals(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in (*COUNTS, "lost")]
    totals = pairs.groupBy(*by, "team_id", "team_name").agg(*sums)
    return totals.withColumn("points", _points()).withColumn(
        "goal_diff", F.col("goals_for") - F.col("goals_against")
    )


def head_to_head(
    pairs: DataFrame, totals: DataFrame, by: Sequence[str], criteria: Sequence[str]
) -> DataFrame:
    """Record among the teams level on every criterion, one level deep."""
    level = [*by, *criteria]
    shared = totals.groupBy(*level).agg(F.count(F.lit(1)).alias("_level")).where("_level > 1")
    tied = (
        totals.alias("t")
        .join(shared.alias("s"), _null_safe("t", "s", [(c, c) for c in level]))
        .select(*[F.col(f"t.{c}").alias(c) for c in [*level, "team_id"]])
    )
    own = pairs.alias("p").join(
        tied.alias("t"), _null_safe("p", "t", [(c, c) for c in [*by, "team_id"]])
    )
    met = own.join(
        tied.alias("o"),
        _null_safe("t", "o", [(c, c) for c in level])
        & (F.col("p.opponent_id") == F.col("o.team_id")),
    )
    won, draw = F.sum("p.won"), F.sum("p.draw")
    scored, conceded = F.sum("p.goals_for"), F.sum("p.goals_against")
    return met.groupBy(*[F.col(f"p.{c}").alias(c) for c in [*by, "team_id"]]).agg(
        (won * V.POINTS_WIN + draw * V.POINTS_DRAW).alias("h2h_points"),
        (scored - conceded).alias("h2h_goal_diff"),
        scored.alias("h2h_goals_for"),
    )


def ranked_standings(
    legs: DataFrame,
    by: Sequence[str] = ("group_code",),
    criteria: Mapping[str, Column] | None = None,
    bounded_groups: bool = True,
    keep_head_to_head: bool = False,
) -> DataFrame:
    """Standings of every group in ``by`` from side rows (see ``goal_legs``).

    ``criteria`` replaces points / goal difference / goals by other descending measures of
    the totals. With ``bounded_groups`` (a league table: tens of teams) the position is a
    window inside the group; pass False when a group can hold very many teams, and the
    position comes from a distributed sort instead.
    """
    by = list(by)
    # totals, tie groups and direct matches all come from these rows; the matches are read once
    pairs = materialise(pair_records(legs, by))
    totals = team_totals(pairs, by)
    names = list(CRITERIA)
    if criteria:
        names = list(criteria)
        totals = totals.select("*", *[e.alias(c) for c, e in criteria.items()])
    h2h = head_to_head(pairs, totals, by, names)
    both = (
        totals.alias("t")
        .join(h2h.alias("h"), _null_safe("t", "h", [(c, c) for c in [*by, "team_id"]]), "left")
        .select("t.*", "h.h2h_points", "h.h2h_goal_diff", "h.h2h_goals_for")
    )
    order = [
        *[F.col(c).desc_nulls_last() for c in names],
        *[F.col(c).desc_nulls_last() for c in ("h2h_points", "h2h_goal_diff", "h2h_goals_for")],
        F.col("team_name").asc_nulls_last(),
        F.col("team_id").asc_nulls_last(),
    ]
    if bounded_groups:
        both = both.withColumn("position", F.row_number().over(W.partitionBy(*by).orderBy(*order)))
    else:
        both = ranked(both, order, "position", by)
    numbers = ("played", "won", "draw", "lost", "points", "goals_for", "goals_against", "goal_diff")
    extra = ("h2h_points", "h2h_goal_diff", "h2h_goals_for") if keep_head_to_head else ()
    return both.select(
        *by, "team_id", "team_name",
        *[F.col(c).cast("int").alias(c) for c in (*numbers, *extra, "position")],
    )
