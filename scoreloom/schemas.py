"""Contracts: nested raw payloads, flattened staging inputs and enforced mart columns."""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T


@cache
def ddl(text: str) -> T.StructType:
    """Parsed on first use, because parsing needs a running session."""
    return T.StructType.fromDDL(text)


_SIDE = "STRUCT<id: BIGINT, name: STRING, tla: STRING>"
_GOALS = "STRUCT<home: BIGINT, away: BIGINT>"

MATCH_ROW = f"""
  id BIGINT, utcDate STRING, status STRING, matchday BIGINT, stage STRING, `group` STRING,
  homeTeam {_SIDE}, awayTeam {_SIDE},
  score STRUCT<winner: STRING, duration: STRING, fullTime: {_GOALS}, halfTime: {_GOALS},
               extraTime: {_GOALS}, penalties: {_GOALS}>,
  lastUpdated STRING
"""
_BADGE = "STRUCT<id: BIGINT, name: STRING, shortName: STRING, tla: STRING, crest: STRING>"
_TABLE_ENTRY = f"""
  position BIGINT, team {_BADGE}, playedGames BIGINT, won BIGINT, draw BIGINT, lost BIGINT,
  points BIGINT, goalsFor BIGINT, goalsAgainst BIGINT, goalDifference BIGINT
"""
STANDING_ROW = f"""
  {_TABLE_ENTRY}, standing STRUCT<`group`: STRING, type: STRING>,
  competition STRUCT<code: STRING>, season STRUCT<id: BIGINT>
"""
SCORER_ROW = """
  player STRUCT<id: BIGINT, name: STRING, nationality: STRING, section: STRING>,
  team STRUCT<id: BIGINT, name: STRING, tla: STRING, crest: STRING>,
  playedMatches BIGINT, goals BIGINT, assists BIGINT, penalties BIGINT
"""

_RAW_ROWS = {"matches": MATCH_ROW, "standings": STANDING_ROW, "scorers": SCORER_ROW}
DATASETS = tuple(_RAW_ROWS)


def raw_rows(dataset: str) -> T.StructType:
    return ddl(_RAW_ROWS[dataset])


def _inline(columns: str) -> str:
    """Column DDL as the field list of a STRUCT type."""
    fields = [f"`{f.name}`: {f.dataType.simpleString()}" for f in ddl(columns)]
    return ", ".join(fields)


def payload(dataset: str) -> T.StructType:
    """One landed document: records in an array, for standings inside groups."""
    if dataset == "standings":
        group = f"STRUCT<`group`: STRING, type: STRING, table: ARRAY<STRUCT<{_inline(_TABLE_ENTRY)}>>>"
        return ddl(
            "competition STRUCT<code: STRING>, season STRUCT<id: BIGINT>, "
            f"standings ARRAY<{group}>"
        )
    return ddl(f"{dataset} ARRAY<STRUCT<{_inline(_RAW_ROWS[dataset])}>>")


ARCHIVE_COLUMNS = (
    T.StructField("extracted_at", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("extraction_date", T.DateType()),
)


def archive_schema(dataset: str) -> T.StructType:
    return T.StructType([*raw_rows(dataset).fields, *ARCHIVE_COLUMNS])


# Fields downstream models need; True = null allowed.
CORE_FIELDS = {
    "matches": {
        "id": ("bigint", False),
        "utcDate": ("string", False),
        "status": ("string", False),
        "stage": ("string", False),
        "group": ("string", True),
        "homeTeam": ("struct", False),
        "awayTeam": ("struct", False),
        "score": ("struct", False),
        "lastUpdated": ("string", False),
    },
    "standings": {
        "position": ("bigint", False),
        "team": ("struct", False),
        "playedGames": ("bigint", False),
        "points": ("bigint", False),
        "goalsFor": ("bigint", False),
        "goalsAgainst": ("bigint", False),
        "goalDifference": ("bigint", False),
        "standing": ("struct", False),
    },
    "scorers": {
        "player": ("struct", False),
        "team": ("struct", False),
        "goals": ("bigint", False),
        "assists": ("bigint", True),
        "penalties": ("bigint", True),
    },
}

_MARTS = {
    "dim_teams": (
        "team_id BIGINT, team_name STRING, team_short_name STRING, team_tla STRING, "
        "team_crest_url STRING, group_code STRING"
    ),
    "fct_matches": (
        "match_id BIGINT, kickoff_at TIMESTAMP_NTZ, status STRING, matchday BIGINT, stage STRING, "
        "group_code STRING, home_team_id BIGINT, home_team_name STRING, away_team_id BIGINT, "
        "away_team_name STRING, full_time_home_goals BIGINT, full_time_away_goals BIGINT, "
        "regulation_home_goals BIGINT, regulation_away_goals BIGINT, half_time_home_goals BIGINT, "
        "half_time_away_goals BIGINT, extra_time_home_goals BIGINT, extra_time_away_goals BIGINT, "
        "penalty_home_goals BIGINT, penalty_away_goals BIGINT, winner STRING, duration STRING, "
        "last_updated_at TIMESTAMP_NTZ, snapshot_date DATE"
    ),
    "fct_group_standings": (
        "group_code STRING, team_id BIGINT, team_name STRING, played INT, won INT, draw INT, "
        "lost INT, points INT, goals_for INT, goals_against INT, goal_diff INT, position INT"
    ),
    "mart_top_scorers": (
        "rank BIGINT, player_id BIGINT, player_name STRING, player_nationality STRING, "
        "team_id BIGINT, team_name STRING, team_tla STRING, team_crest_url STRING, "
        "played_matches BIGINT, goals BIGINT, assists BIGINT, penalties BIGINT"
    ),
    "mart_edition_comparison": (
        "year INT, host STRING, winner STRING, teams INT, matches INT, goals BIGINT, "
        "goals_per_match DOUBLE, is_current BOOLEAN, goals_per_match_rank INT"
    ),
}


def mart(name: str) -> T.StructType:
    """Enforced names, order and types of a mart."""
    return ddl(_MARTS[name])


EDITION_SEED = (
    "year INT, host STRING, winner STRING, teams INT, matches INT, goals INT, goals_per_match DOUBLE"
)
TEAM_STATS = (
    "team STRING, possession DOUBLE, shots INT, sot INT, sot_pct DOUBLE, g_per_sh DOUBLE, ga INT, "
    "sota INT, saves INT, save_pct DOUBLE, cs INT, crdy INT, crdr INT"
)
RUN_LOG = (
    "run_id STRING, recorded_at STRING, stage STRING, dataset STRING, rows BIGINT, "
    "duration_s DOUBLE, status STRING, error STRING"
)
EVENT = (
    f"id BIGINT, startTimestamp BIGINT, homeTeam {_SIDE}, awayTeam {_SIDE}, "
    "tournament STRUCT<uniqueTournament: STRUCT<id: BIGINT>>, season STRUCT<id: BIGINT>, "
    "roundInfo STRUCT<name: STRING>"
)
_ITEM = "STRUCT<name: STRING, home: STRING, away: STRING>"
# documents keyed by event id: value type of the map
EVENT_STATISTICS = f"statistics ARRAY<STRUCT<groups: ARRAY<STRUCT<statisticsItems: ARRAY<{_ITEM}>>>>>"
EVENT_SHOTS = (
    "shotmap ARRAY<STRUCT<playerCoordinates: STRUCT<x: DOUBLE, y: DOUBLE>, xg: STRING, "
    "shotType: STRING, isHome: BOOLEAN, player: STRUCT<name: STRING>>>"
)
