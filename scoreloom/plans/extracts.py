"""Serving extracts over the star schema, one function per result set."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.display import iso_utc
from ..functions.scores import decided_by_side, score_label
from ..operators.quality import passed_and_total
from ..operators.ranking import lagged, top_k, top_k_per_key
from ..operators.reshape import nest_rows, with_group_values



def finished() -> Column:
    return F.col("status") == V.FINISHED


def stage_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(V.STAGE_ROWS),
        "stage STRING, stage_order INT, label STRING, short_label STRING, depth INT",
    )


def _match_goals() -> Column:
    home, away = F.col("regulation_home_goals"), F.col("regulation_away_goals")
    return F.coalesce(home, F.lit(0)) + F.coalesce(away, F.lit(0))


def _goals_when_finished() -> Column:
    return F.sum(F.when(finished(), _match_goals()))


def _per_match(total: Column, n: Column) -> Column:
    return F.round(total.cast("double") / F.nullif(n, F.lit(0)), 2)


def match_cards(
    facts: DataFrame, teams: DataFrame, by: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """Matches with both teams' short code and crest; goals are those of the match itself.

    ``by`` are keys that teams share with matches; ``keep`` are further match columns.
    """
    badge = teams.select(*by, "team_id", "team_tla", "team_crest_url")

    def side(name: str) -> DataFrame:
        return badge.select(
            *by, F.col("team_id").alias(f"{name}_team_id"),
            F.col("team_tla").alias(f"{name}_team_tla"), F.col("team_crest_url").alias(f"{name}_crest"),
        )

    joined = facts.join(side("home"), [*by, "home_team_id"], "left").join(
        side("away"), [*by, "away_team_id"], "left"
    )
    return joined.select(
        *by, *keep, "match_id", "kickoff_at", "status", "stage", "group_code", "matchday",
        "home_team_id", "home_team_name", "home_team_tla", "home_crest",
        "away_team_id", "away_team_name", "away_team_tla", "away_crest",
        F.col("regulation_home_goals").alias("full_time_home_goals"),
        F.col("regulation_away_goals").alias("full_time_away_goals"),
        "penalty_home_goals", "penalty_away_goals", "winner", "duration",
    )


def key_metrics(facts: DataFrame, teams: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    played, goals = F.count_if(finished()), _goals_when_finished()
    numbers = facts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("matches_total"), played.alias("matches_played"),
        goals.alias("goals_scored"), _per_match(goals, played).alias("avg_goals_per_match"),
    )
    counted = teams.groupBy(*by).agg(F.count(F.lit(1)).alias("teams"))
    both = with_group_values(numbers, counted, by)
    return both.select(
        *by, "matches_total", "matches_played", "goals_scored", "teams", "avg_goals_per_match"
    )


def latest_results(cards: DataFrame, k: int = 8) -> DataFrame:
    newest = [F.col("kickoff_at").desc_nulls_last(), F.col("match_id").desc_nulls_last()]
    return top_k(cards.where(finished()), newest, k)


def upcoming_matches(cards: DataFrame, k: int = 8) -> DataFrame:
    soonest = [F.col("kickoff_at").asc_nulls_last(), F.col("match_id").asc_nulls_last()]
    return top_k(cards.where(F.col("status").isin(*V.UPCOMING)), soonest, k)


def qualified_standings(
    standings: DataFrame, teams: DataFrame, by: Sequence[str] = (),
    direct: int = 2, extra_position: int = 3, extra_places: int = 8,
    team_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Standings with who goes through: direct places and the best of one further place.

    The candidates are one row per group, cut to ``extra_places`` per competition before
    anything is shuffled twice.
    """
    order = [
        F.col("points").desc_nulls_last(), F.col("goal_diff").desc_nulls_last(),
        F.col("goals_for").desc_nulls_last(), F.col("team_name").asc_nulls_last(),
        F.col("team_id").asc_nulls_last(),
    ]
    at_extra = standings.where(F.col("position") == extra_position)
    best = top_k_per_key(at_extra, by, order, extra_places, "_n") if by else (
        top_k(at_extra, order, extra_places)
    )
    best = best.select(*by, "group_code", "team_id", F.lit(True).alias("_best"))
    shared = by if team_keys is None else team_keys
    badge = teams.select(*shared, "team_id", "team_tla", F.col("team_crest_url").alias("crest"))
    rows = standings.join(badge, [*shared, "team_id"], "left").join(
        best, [*by, "group_code", "team_id"], "left"
    )
    best_extra = F.coalesce("_best", F.lit(False))
    return rows.select(
        *by, "group_code", "position", "team_id", "team_name", "team_tla", "crest", "played",
        "won", "draw", "lost", "points", "goals_for", "goals_against", "goal_diff",
        ((F.col("position") <= direct) | best_extra).alias("qualified"),
        best_extra.alias("best_third"),
    )


def groups_nested(qualified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One document per group with its standings in order."""
    fields = [c for c in qualified.columns if c not in by]
    return nest_rows(qualified, [*by, "group_code"], ["position"], fields, "standings")


def knockout_matches(cards: DataFrame) -> DataFrame:
    return cards.where(F.col("stage").isin(*V.KNOCKOUT))


def bracket_nested(cards: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One document per knockout round that has matches, in playing order."""
    dim = stage_dim(cards.sparkSession).select("stage", "stage_order", "label")
    fields = [c for c in cards.columns if c not in by]
    rounds = nest_rows(
        knockout_matches(cards), [*by, "stage"], ["kickoff_at", "match_id"], fields, "matches"
    )
    return rounds.join(dim, "stage").select(*by, "stage_order", "stage", "label", "matches")


def goals_by_stage(facts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Finished matches and goals per stage; an unknown stage keeps its name and sorts last."""
    played, goals = F.count_if(finished()), _goals_when_finished()
    numbers = facts.groupBy(*by, "stage").agg(
        played.alias("matches"), goals.alias("goals"),
        _per_match(goals, played).alias("avg_goals"),
    )
    dim = stage_dim(facts.sparkSession).select("stage", "stage_order", "short_label")
    return numbers.join(dim, "stage", "left").select(
        *by, "stage", "matches", "goals", "avg_goals",
        F.coalesce("short_label", "stage").alias("label"),
        F.coalesce("stage_order", F.lit(V.UNKNOWN_STAGE_ORDER)).alias("stage_order"),
    )


def scorelines(facts: DataFrame, k: int = 8) -> DataFrame:
    """Most frequent final scores, larger number first."""
    home, away = F.col("regulation_home_goals"), F.col("regulation_away_goals")
    label = score_label(F.greatest(home, away), F.least(home, away))
    counts = (
        facts.where(finished() & home.isNotNull())
        .groupBy(label.alias("scoreline"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return top_k(counts, [F.col("count").desc_nulls_last(), F.col("scoreline").asc_nulls_last()], k)


def results_split(facts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Home wins, draws and away wins by declared winner."""
    names = {"home_wins": "HOME_TEAM", "draws": "DRAW", "away_wins": "AWAY_TEAM"}
    return facts.where(finished()).groupBy(*by).agg(
        *[F.count_if(F.col("winner") == w).alias(n) for n, w in names.items()]
    )


def edition_table(editions: DataFrame) -> DataFrame:
    """All editions as one document with the running edition's headline numbers."""
    fields = editions.columns
    total = nest_rows(editions.withColumn("_all", F.lit(1)), ["_all"], ["year"], fields, "editions")
    now = F.filter("editions", lambda e: e["is_current"])
    head = F.get(now, F.lit(0))
    return total.select(
        "editions",
        head["year"].alias("current_year"),
        head["goals_per_match"].alias("current_goals_per_match"),
        head["goals_per_match_rank"].alias("current_rank"),
        F.size("editions").cast("long").alias("total_editions"),
    )


def champion(cards: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The newest final, with winner and runner-up once it is finished.

    A finished final without a home win counts for the away side.
    """
    order = [F.col("kickoff_at").desc_nulls_last(), F.col("match_id").desc_nulls_last()]
    finals = cards.where(F.col("stage") == "FINAL")
    last = top_k_per_key(finals, by, order, 1, "_n").drop("_n") if by else top_k(finals, order, 1)
    home_won = F.coalesce(F.col("winner") == "HOME_TEAM", F.lit(False))
    home_goals, away_goals = F.col("full_time_home_goals"), F.col("full_time_away_goals")

    def once_finished(value: Column) -> Column:
        return F.when(finished(), value)

    def pick(home: str, away: str) -> Column:
        return F.when(home_won, F.col(home)).otherwise(F.col(away))

    score = F.when(home_won, score_label(home_goals, away_goals)).otherwise(
        score_label(away_goals, home_goals)
    )
    return last.select(
        *by, "match_id", "kickoff_at", "status",
        once_finished(pick("home_team_name", "away_team_name")).alias("team_name"),
        once_finished(pick("home_crest", "away_crest")).alias("crest"),
        once_finished(pick("away_team_name", "home_team_name")).alias("runner_up"),
        once_finished(score).alias("final_score"),
    )


def top_scorers(mart: DataFrame, k: int = 15) -> DataFrame:
    return top_k(mart, [F.col("rank").asc_nulls_last()], k).select(
        "rank", "player_name", "player_nationality", "team_name", "team_tla", "team_crest_url",
        "played_matches", "goals", "assists", "penalties",
    )


def run_summary(runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Runs logged and runs without a single failed record."""
    per_run = runs.groupBy(*by, "run_id").agg(
        F.max(F.when(F.coalesce(F.col("status"), F.lit("")) != "ok", 1).otherwise(0)).alias("failed")
    )
    return per_run.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs_total"), F.count_if(F.col("failed") == 0).alias("runs_ok")
    )


def metadata(
    staged_matches: DataFrame, standings: DataFrame, runs: DataFrame, checks: DataFrame,
    footprint: DataFrame, source: str, competition: str, now: datetime,
) -> DataFrame:
    """Freshness banner: one row from five one-row aggregates."""
    newest = staged_matches.agg(F.max("extracted_at").alias("last_at"))
    teams = standings.agg(F.count(F.lit(1)).cast("string").alias("n"))
    parts = newest.crossJoin(teams).crossJoin(run_summary(runs))
    parts = parts.crossJoin(passed_and_total(checks)).crossJoin(footprint)
    return parts.select(
        iso_utc(F.lit(now)).alias("generated_at"), iso_utc(F.col("last_at")).alias("last_ingestion"),
        F.lit(source).alias("source"), F.lit(competition).alias("competition"),
        F.col("passed").alias("checks_passed"), F.col("total").alias("checks_total"),
        "ingestion_days", F.concat("n", F.lit("/"), "n").alias("reconciliation"),
        F.struct("runs_total", "runs_ok").alias("ops"),
    )


# --- derived context over small extracts ---------------------------------------------------


def edition_context(editions: DataFrame, modern_from: int = 1990, large_field: int = 48) -> DataFrame:
    """How the running edition compares with all earlier ones, in one row."""
    e = editions.alias("e")
    cur = editions.where("is_current").select(
        F.col("year").alias("c_year"), F.col("matches").alias("c_matches"),
        F.col("goals").alias("c_goals"), F.col("teams").alias("c_teams"),
        F.col("goals_per_match").alias("c_rate"), F.col("winner").alias("c_winner"),
    )
    past, rate, year = ~F.col("is_current"), F.col("goals_per_match"), F.col("year")
    latest_past = F.max_by("matches", F.when(past, year))
    return (
        e.crossJoin(cur)  # one current row
        .groupBy("c_year", "c_matches", "c_goals", "c_teams", "c_rate", "c_winner")
        .agg(
            F.max(F.when(past, year)).alias("previous_year"),
            latest_past.alias("previous_matches"),
            F.round(F.avg(rate), 6).alias("all_time_avg"),
            F.round(F.avg(F.when(past & (year >= modern_from), rate)), 6).alias("modern_avg"),
            F.max(F.when(past & (rate > F.col("c_rate")), year)).alias("highest_since"),
            F.max(F.when(past, F.col("goals"))).alias("most_goals_before"),
            F.count_if(past & (F.col("teams") >= large_field)).alias("large_fields_before"),
            F.count_if(F.col("winner") == F.col("c_winner")).alias("champion_titles"),
            F.max(F.when(past & (F.col("winner") == F.col("c_winner")), year)).alias("champion_last_title"),
        )
        .select(
            F.col("c_year").alias("year"), "previous_year",
            (F.col("c_matches") - F.col("previous_matches")).cast("long").alias("matches_delta"),
            (F.col("c_goals") > F.col("most_goals_before")).alias("goals_record"),
            (F.col("large_fields_before") == 0).alias("first_large_field"),
            "highest_since", "all_time_avg", (F.col("c_rate") > F.col("all_time_avg")).alias("above_all_time"),
            "modern_avg", (F.col("c_rate") > F.col("modern_avg")).alias("above_modern"),
            "champion_titles", "champion_last_title",
        )
    )


def champion_on_podium(scorers: DataFrame, champions: DataFrame, k: int = 3) -> DataFrame:
    """Leading scorer, and whether a champion's player is among the first ``k``."""
    first = top_k(scorers, [F.col("rank").asc_nulls_last()], k)
    named = champions.select(F.col("team_name").alias("champion_name"))
    return first.crossJoin(named).groupBy("champion_name").agg(  # k rows, one champion
        F.min_by("player_name", "rank").alias("golden_boot"),
        F.coalesce(F.bool_or(F.col("team_name") == F.col("champion_name")), F.lit(False)).alias("on_podium"),
    )


def shares(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of each row in the total and in the maximum of its group."""
    totals = df.groupBy(*by).agg(F.sum(value).alias("_sum"), F.max(value).alias("_max"))
    both = with_group_values(df, totals, by)
    v = F.col(value).cast("double")
    return both.select(
        *df.columns,
        F.round(v / F.nullif(F.col("_sum"), F.lit(0)), 6).alias("share_of_total"),
        F.round(v / F.nullif(F.col("_max"), F.lit(0)), 6).alias("share_of_max"),
    )


def decided_teams(facts: DataFrame, by: Sequence[str] = (), *keep: str) -> DataFrame:
    """Decisive finished matches from the winner's point of view; ``keep`` columns pass through."""
    home_first = ("home_team_id", "home_team_name", "away_team_id", "away_team_name")
    away_first = ("away_team_id", "away_team_name", "home_team_id", "home_team_name")
    out = ("winner_id", "winner_name", "loser_id", "loser_name")
    sides = [
        decided_by_side("winner", F.col(h), F.col(a)).alias(o)
        for o, h, a in zip(out, home_first, away_first, strict=True)
    ]
    goals = [
        decided_by_side("winner", F.col(f"regulation_{x}_goals"), F.col(f"regulation_{y}_goals")).alias(o)
        for o, x, y in (("winner_goals", "home", "away"), ("loser_goals", "away", "home"))
    ]
    kicks = [
        decided_by_side("winner", F.col(f"penalty_{x}_goals"), F.col(f"penalty_{y}_goals")).alias(o)
        for o, x, y in (("winner_kicks", "home", "away"), ("loser_kicks", "away", "home"))
    ]
    decisive = facts.where(finished() & F.col("winner").isin("HOME_TEAM", "AWAY_TEAM"))
    rows = decisive.select(*by, *keep, "match_id", "stage", "duration", "winner", *sides, *goals, *kicks)
    return rows.withColumn(
        "score", score_label("winner_goals", "loser_goals", "duration", "winner_kicks", "loser_kicks")
    )


def previous_edition(editions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every edition beside the one before it; one row per edition and competition."""
    beside = lagged(editions, [F.col("year").asc_nulls_last()], {"previous_year": "year", "_matches": "matches"}, by)
    return beside.withColumn("matches_delta", (F.col("matches") - F.col("_matches")).cast("long")).drop("_matches")


def archive_footprint(archive: DataFrame) -> DataFrame:
    """Days and rows of an archive partitioned by day, from partition names and footers alone: no column is read."""
    per_day = archive.groupBy("extraction_date").agg(F.count(F.lit(1)).alias("rows"))
    return per_day.agg(F.count(F.lit(1)).alias("ingestion_days"), F.coalesce(F.sum("rows"), F.lit(0)).alias("archived_rows"))
