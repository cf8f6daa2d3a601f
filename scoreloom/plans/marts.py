"""Star schema from staged snapshots.

``by`` names competition keys that precede every business key; it is empty for an archive
that holds a single competition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..config import Edition
from ..functions.scores import decided_by_side, without_shootout
from ..operators.ranking import latest_per_key, ranked
from ..operators.reshape import goal_legs, match_sides
from ..operators.standings import ranked_standings
from ..schemas import mart as mart_schema

SNAPSHOT_ORDER = ("extraction_date", "extracted_at")


def _cast_as(df: DataFrame, mart: str, by: Sequence[str] = ()) -> DataFrame:
    return df.select(*by, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in mart_schema(mart)])


def latest_matches(staged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The newest snapshot of every match: the one place that decides what is current."""
    return latest_per_key(staged, [*by, "match_id"], SNAPSHOT_ORDER)


def dim_teams(
    staged_standings: DataFrame, current_matches: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Teams of the newest standings, plus teams that only matches know."""
    keys = [*by, "team_id"]
    known = latest_per_key(staged_standings, keys, SNAPSHOT_ORDER)
    from_matches = (
        match_sides(
            current_matches,
            home={"team_id": "home_team_id", "team_name": "home_team_name", "team_tla": "home_team_tla"},
            away={"team_id": "away_team_id", "team_name": "away_team_name", "team_tla": "away_team_tla"},
            keep=list(by),
        )
        .where(F.col("team_id").isNotNull())
        .distinct()
    )
    only_matches = from_matches.join(known.select(*keys), keys, "left_anti")
    both = known.select(*by, *[f.name for f in mart_schema("dim_teams")]).unionByName(
        only_matches, allowMissingColumns=True
    )
    return _cast_as(both, "dim_teams", by)


def fct_matches(current: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per match with goals of the match itself beside the reported totals."""
    facts = current.withColumns({
        "regulation_home_goals": without_shootout("full_time_home_goals", "penalty_home_goals"),
        "regulation_away_goals": without_shootout("full_time_away_goals", "penalty_away_goals"),
        "snapshot_date": F.col("extraction_date"),
    })
    return _cast_as(facts, "fct_matches", by)


def group_legs(facts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Side rows of finished group matches, by reported full-time goals."""
    finished = facts.where((F.col("stage") == V.GROUP_STAGE) & (F.col("status") == V.FINISHED))
    return goal_legs(finished, [*by, "group_code"], "full_time_home_goals", "full_time_away_goals")


def fct_group_standings(
    facts: DataFrame, by: Sequence[str] = (), bounded_groups: bool = True
) -> DataFrame:
    table = ranked_standings(
        group_legs(facts, by), [*by, "group_code"], bounded_groups=bounded_groups
    )
    return _cast_as(table, "fct_group_standings", by)


def scorer_order() -> list:
    return [
        F.col("goals").desc_nulls_last(), F.col("penalties").asc_nulls_last(),
        F.col("assists").desc_nulls_last(), F.col("player_name").asc_nulls_last(),
        F.col("player_id").asc_nulls_last(),
    ]


def mart_top_scorers(staged_scorers: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Newest snapshot of every scorer with a distributed rank over all of them."""
    current = latest_per_key(staged_scorers, [*by, "player_id"], SNAPSHOT_ORDER)
    return _cast_as(ranked(current, scorer_order(), "rank", by), "mart_top_scorers", by)


def mart_edition_comparison(history: DataFrame, facts: DataFrame, edition: Edition, year: Column | None = None) -> DataFrame:
    """Past editions from the seed beside the running one, ranked by goals per match.

    ``year``, an aggregate over the facts, replaces the year of the edition's parameters.

    The ranking window has no key: its input is one row per edition of a tournament.
    """
    goals = F.sum(F.col("regulation_home_goals") + F.col("regulation_away_goals"))
    champion = F.max(
        F.when(F.col("stage") == "FINAL", decided_by_side("winner", F.col("home_team_name"), F.col("away_team_name")))
    )
    n = F.count(F.lit(1))
    running = facts.where(F.col("status") == V.FINISHED).agg(
        champion.alias("winner"), n.alias("matches"), goals.alias("goals"),
        F.round(goals.cast("double") / F.nullif(n, F.lit(0)), 2).alias("goals_per_match"),
        (F.lit(edition.year) if year is None else year).alias("year"),
    ).select(
        "year", F.lit(edition.host).alias("host"), "winner",
        F.lit(edition.expected_teams).alias("teams"), "matches", "goals", "goals_per_match",
        F.lit(True).alias("is_current"),
    )
    editions = history.withColumn("is_current", F.lit(False)).unionByName(running)
    return _cast_as(with_edition_rank(editions), "mart_edition_comparison")


def with_edition_rank(editions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rank by goals per match; numbered over the cluster, so no task holds all editions."""
    order = [F.col("goals_per_match").desc_nulls_last(), F.col("year").asc_nulls_last()]
    return ranked(editions, order, "goals_per_match_rank", by).withColumn("goals_per_match_rank", F.col("goals_per_match_rank").cast("int"))
