"""Flattening of raw snapshot rows; the snapshot history is kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text


def _picked(paths: dict[str, str]) -> list[Column]:
    return [F.col(path).alias(name) for name, path in paths.items()]


def _periods() -> dict[str, str]:
    parts = {"full_time": "fullTime", "half_time": "halfTime", "extra_time": "extraTime", "penalty": "penalties"}
    return {
        f"{name}_{side}_goals": f"score.{field}.{side}"
        for name, field in parts.items()
        for side in ("home", "away")
    }


def stage_matches(raw: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Match snapshots with flat columns; ``extra`` raw columns (a competition) are kept."""
    return raw.select(
        *extra,
        F.col("id").alias("match_id"),
        text.utc_wall_time("utcDate").alias("kickoff_at"),
        "status", "matchday", "stage",
        text.group_code("group").alias("group_code"),
        *_picked({
            "home_team_id": "homeTeam.id", "home_team_name": "homeTeam.name",
            "home_team_tla": "homeTeam.tla", "away_team_id": "awayTeam.id",
            "away_team_name": "awayTeam.name", "away_team_tla": "awayTeam.tla",
            "winner": "score.winner", "duration": "score.duration", **_periods(),
        }),
        text.utc_wall_time("lastUpdated").alias("last_updated_at"),
        "extracted_at", "extraction_date",
    )


def stage_standings(raw: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        *extra,
        *_picked({
            "team_id": "team.id", "team_name": "team.name", "team_short_name": "team.shortName",
            "team_tla": "team.tla", "team_crest_url": "team.crest",
        }),
        text.group_code(F.col("standing.group")).alias("group_code"),
        *_picked({
            "standing_type": "standing.type", "position": "position", "played": "playedGames",
            "won": "won", "draw": "draw", "lost": "lost", "points": "points",
            "goals_for": "goalsFor", "goals_against": "goalsAgainst", "goal_diff": "goalDifference",
        }),
        "extracted_at", "extraction_date",
    )


def stage_scorers(raw: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Scorer snapshots; absent assists and penalties count as none."""
    return raw.select(
        *extra,
        *_picked({
            "player_id": "player.id", "player_name": "player.name",
            "player_nationality": "player.nationality", "player_section": "player.section",
            "team_id": "team.id", "team_name": "team.name", "team_tla": "team.tla",
            "team_crest_url": "team.crest", "played_matches": "playedMatches", "goals": "goals",
        }),
        F.coalesce("assists", F.lit(0)).alias("assists"),
        F.coalesce("penalties", F.lit(0)).alias("penalties"),
        "extracted_at", "extraction_date",
    )
