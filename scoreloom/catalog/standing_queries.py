"""Standings, qualification, editions and what they are reconciled with."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..config import Edition
from ..functions.scores import decided_by_side
from ..operators import ranked_standings
from ..operators.reconcile import differences
from ..operators.reshape import goal_legs
from ..plans import extracts as X
from ..plans.marts import (
    dim_teams, fct_group_standings, group_legs, latest_matches, mart_edition_comparison,
    with_edition_rank,
)
from ..plans.staging import stage_matches, stage_standings
from .contests import BY, FACTS, LEGS, STANDING_COLUMNS, facts, raw_matches, standings_sql, teams
from .registry import query

GROUP_KEYS = "competition, group_code"
STANDINGS = FACTS + LEGS + standings_sql(GROUP_KEYS)


@query("group_standings", STANDINGS + f" select {GROUP_KEYS}, {STANDING_COLUMNS} from standings")
def q_group_standings(spark, sf):
    return fct_group_standings(facts(spark, sf), BY)


@query("group_standings_distributed", STANDINGS + f" select {GROUP_KEYS}, {STANDING_COLUMNS} from standings")
def q_group_standings_distributed(spark, sf):
    """The same table with positions from a distributed sort, for groups of any size."""
    return fct_group_standings(facts(spark, sf), BY, bounded_groups=False)


@query("all_time_standings", FACTS + LEGS + standings_sql("group_code") + f"""
  select group_code, {STANDING_COLUMNS} from standings""")
def q_all_time_standings(spark, sf):
    return ranked_standings(group_legs(facts(spark, sf)), ["group_code"])


@query("head_to_head_standings", FACTS + LEGS + standings_sql(
    "group_code", criteria={"bucket": "floor(points / 50)"}) + f"""
  select group_code, {STANDING_COLUMNS}, h2h_points, h2h_goal_diff, h2h_goals_for from standings""")
def q_head_to_head_standings(spark, sf):
    """One coarse criterion leaves many teams level, so direct matches decide."""
    return ranked_standings(
        group_legs(facts(spark, sf)), ["group_code"],
        criteria={"bucket": F.floor(F.col("points") / 50)}, keep_head_to_head=True,
    )


# Who goes through: the first two of a group, and the two best of all thirds.
QUALIFIED = STANDINGS + """, ordered as (
  select *, case when position = 3 then row_number() over (partition by competition, position
    order by points desc, goal_diff desc, goals_for desc, team_name, team_id) end as among_thirds
  from standings
), qualified as (
  select o.* exclude (among_thirds, h2h_points, h2h_goal_diff, h2h_goals_for), t.team_tla, t.team_crest_url as crest,
    coalesce(among_thirds < 3, false) as best_third, o.position < 3 or coalesce(among_thirds < 3, false) as qualified
  from ordered o left join teams t using (team_id))"""


def qualified(spark, sf):
    table = fct_group_standings(facts(spark, sf), BY)
    return X.qualified_standings(table, teams(spark, sf), BY, extra_places=2, team_keys=())


@query("groups_qualified", QUALIFIED + " select * from qualified")
def q_groups_qualified(spark, sf):
    return qualified(spark, sf)


@query("group_documents", QUALIFIED + """ select competition, group_code, count(*) as n_teams,
    string_agg(team_name, ',' order by position) as in_order from qualified group by all""")
def q_group_documents(spark, sf):
    nested = X.groups_nested(qualified(spark, sf), BY)
    names = F.transform("standings", lambda s: s["team_name"])
    return nested.select(
        "competition", "group_code", F.size("standings").cast("long").alias("n_teams"),
        F.array_join(names, ",").alias("in_order"),
    )


# Published tables lag behind: they hold the matches of the first nine months only.
OFFICIAL = FACTS + LEGS + standings_sql(GROUP_KEYS) + standings_sql(
    GROUP_KEYS, "(select l.* from legs l join facts f using (match_id) where month(f.kickoff_at) <= 9 "
    "and l.stage = 'GROUP_STAGE')", name="official")

_COMPARED = ("position", "points", "goal_diff", "goals_for")


@query("reconcile_standings", OFFICIAL + f""", stacked as (
    select 'computed' as of, competition, group_code, team_id, team_name, {', '.join(_COMPARED)} from standings
    union all select 'official', competition, group_code, team_id, team_name, {', '.join(_COMPARED)} from official)
  select competition, group_code, team_id, min(team_name) as team_name,
    {', '.join(f"max({c}) filter (where of = '{s}') as {s}_{c}" for c in _COMPARED for s in ('computed', 'official'))}
  from stacked group by competition, group_code, team_id
  having count(*) = 1 or {' or '.join(f'min({c}) <> max({c})' for c in _COMPARED)}""")
def q_reconcile(spark, sf):
    all_year = facts(spark, sf)
    published = fct_group_standings(all_year.where(F.month("kickoff_at") <= 9), BY)
    return differences(
        fct_group_standings(all_year, BY), published, [*BY, "group_code", "team_id"],
        ["position", "points", "goal_diff", "goals_for"], carry=["team_name"],
    )


# --- team dimension from published standings snapshots --------------------------------------


def raw_standings(spark, sf):
    """Nested standings snapshots: the table after nine months, and at the end of the year."""
    legs = goal_legs(
        facts(spark, sf).where(X.finished() & (F.col("stage") == "GROUP_STAGE")),
        [*BY, "group_code", "kickoff_at"], "full_time_home_goals", "full_time_away_goals",
    )
    cuts = F.array(F.struct(F.lit(9).alias("m"), F.lit("-09-30").alias("d")),
                   F.struct(F.lit(12).alias("m"), F.lit("-12-31").alias("d")))
    dated = legs.select("*", F.explode(cuts).alias("cut")).where(F.month("kickoff_at") <= F.col("cut.m"))
    day = F.concat(F.col("competition").cast("string"), F.col("cut.d")).cast("date")
    table = ranked_standings(
        dated.withColumn("extraction_date", day), [*BY, "group_code", "extraction_date"]
    )
    badge = teams(spark, sf).select("team_id", "team_short_name", "team_tla", "team_crest_url")
    return table.join(badge, "team_id").select(
        "competition", F.col("position").cast("long").alias("position"),
        F.struct(
            F.col("team_id").alias("id"), F.col("team_name").alias("name"),
            F.col("team_short_name").alias("shortName"), F.col("team_tla").alias("tla"),
            F.col("team_crest_url").alias("crest"),
        ).alias("team"),
        F.col("played").alias("playedGames"), "won", "draw", "lost", "points",
        F.col("goals_for").alias("goalsFor"), F.col("goals_against").alias("goalsAgainst"),
        F.col("goal_diff").alias("goalDifference"),
        F.struct(F.concat(F.lit("Group "), "group_code").alias("group"), F.lit("TOTAL").alias("type")).alias("standing"),
        F.col("extraction_date").cast("timestamp").alias("extracted_at"), "extraction_date",
    )


SNAPSHOT_TABLES = FACTS + LEGS + """, dated as (
  select l.*, cast(f.competition || c.d as date) as extraction_date
  from legs l join facts f using (match_id)
  join (values (9, '-09-30'), (12, '-12-31')) c(m, d) on month(f.kickoff_at) <= c.m
  where l.stage = 'GROUP_STAGE')""" + standings_sql("competition, group_code, extraction_date", "dated")


@query("stage_standings", SNAPSHOT_TABLES + """ select s.competition, s.team_id, s.team_name, t.team_short_name,
    t.team_tla, t.team_crest_url, s.group_code, 'TOTAL' as standing_type, cast(s.position as bigint) as position,
    s.played, s.won, s.draw, s.lost, s.points, s.goals_for, s.goals_against, s.goal_diff, s.extraction_date
  from standings s join teams t using (team_id)""")
def q_stage_standings(spark, sf):
    return stage_standings(raw_standings(spark, sf), BY).drop("extracted_at")


@query("dim_teams", SNAPSHOT_TABLES + """, latest as (
    select * from (select *, row_number() over (partition by competition, team_id order by extraction_date desc) as rn
      from standings) where rn = 1),
  played as (
    select distinct competition, home_team_id as team_id, home_team_name as team_name from facts
    union select distinct competition, away_team_id, away_team_name from facts)
  select l.competition, l.team_id, l.team_name, t.team_short_name, t.team_tla, t.team_crest_url, l.group_code
  from latest l join teams t using (team_id)
  union all
  select p.competition, p.team_id, p.team_name, null, 'N' || lpad(cast(p.team_id as varchar), 2, '0'), null, null
  from played p where not exists (
    select 1 from latest l where l.competition = p.competition and l.team_id = p.team_id)""")
def q_dim_teams(spark, sf):
    staged = stage_standings(raw_standings(spark, sf), BY)
    current = latest_matches(stage_matches(raw_matches(spark, sf), BY), BY)
    return dim_teams(staged, current, BY)


# --- editions: one per competition year -------------------------------------------------------


def yearly_editions(spark, sf):
    """Edition rows of all years from their finished matches."""
    finished = facts(spark, sf).where(X.finished())
    goals = F.sum(F.col("regulation_home_goals") + F.col("regulation_away_goals"))
    champion = decided_by_side("winner", F.col("home_team_name"), F.col("away_team_name"))
    n = F.count(F.lit(1))
    return finished.groupBy(F.col("competition").alias("year")).agg(
        F.min("home_team_name").alias("host"),
        F.max(F.when(F.col("stage") == "FINAL", champion)).alias("winner"),
        F.countDistinct("home_team_id").cast("int").alias("teams"),
        n.cast("int").alias("matches"), goals.alias("goals"),
        F.round(goals.cast("double") / n, 2).alias("goals_per_match"),
    )


EDITIONS = FACTS + """, yearly as (
  select competition as year, min(home_team_name) as host,
    max(case when stage = 'FINAL' and winner = 'HOME_TEAM' then home_team_name
             when stage = 'FINAL' and winner = 'AWAY_TEAM' then away_team_name end) as winner,
    cast(count(distinct home_team_id) as integer) as teams, cast(count(*) as integer) as matches,
    cast(sum(regulation_home_goals + regulation_away_goals) as bigint) as goals,
    round(sum(regulation_home_goals + regulation_away_goals) / count(*), 2) as goals_per_match
  from facts where status = 'FINISHED' group by competition
), united as (
  select * replace (case when is_current then 'Joint hosts' else host end as host, case when is_current then 25 else teams end as teams)
  from (select *, year = (select max(competition) from facts) as is_current from yearly)
), editions as (
  select *, cast(row_number() over (order by goals_per_match desc, year) as integer) as goals_per_match_rank
  from united)"""

# The newest year is the running edition; its year comes from the rows.
RUNNING = Edition(0, "Joint hosts", 0, 25, 0, date(2001, 1, 1), date(2001, 12, 31))


def editions(spark, sf):
    """All past years, and the newest one as the running edition."""
    rows = facts(spark, sf)
    newest = F.broadcast(rows.agg(F.max("competition").alias("_newest")))  # one row
    history = yearly_editions(spark, sf).join(newest, F.col("year") < F.col("_newest")).drop("_newest")
    running = rows.join(newest, F.col("competition") == F.col("_newest")).drop("_newest")
    return mart_edition_comparison(history, running, RUNNING, F.max("competition"))


@query("edition_comparison", EDITIONS + " select * from editions")
def q_edition_comparison(spark, sf):
    return editions(spark, sf)


@query("edition_document", EDITIONS + """ select count(*) as total_editions,
    string_agg(cast(year as varchar), ',' order by year) as years,
    max(case when is_current then year end) as current_year,
    max(case when is_current then goals_per_match end) as current_goals_per_match,
    max(case when is_current then goals_per_match_rank end) as current_rank from editions""")
def q_edition_document(spark, sf):
    years = F.transform("editions", lambda e: e["year"].cast("string"))
    return X.edition_table(editions(spark, sf)).select(
        "total_editions", F.array_join(years, ",").alias("years"), "current_year",
        "current_goals_per_match", "current_rank",
    )


@query("edition_context", EDITIONS + """, cur as (select * from editions where is_current),
  past as (select * from editions where not is_current)
  select c.year, (select max(year) from past) as previous_year,
    cast(c.matches - (select matches from past order by year desc limit 1) as bigint) as matches_delta,
    c.goals > (select max(goals) from past) as goals_record,
    (select count(*) from past where teams >= 25) = 0 as first_large_field,
    (select max(year) from past where goals_per_match > c.goals_per_match) as highest_since,
    round((select avg(goals_per_match) from editions), 6) as all_time_avg,
    c.goals_per_match > (select avg(goals_per_match) from editions) as above_all_time,
    round((select avg(goals_per_match) from past where year >= 1998), 6) as modern_avg,
    c.goals_per_match > (select avg(goals_per_match) from past where year >= 1998) as above_modern,
    (select count(*) from editions where winner = c.winner) as champion_titles,
    (select max(year) from past where winner = c.winner) as champion_last_title
  from cur c""")
def q_edition_context(spark, sf):
    return X.edition_context(editions(spark, sf), modern_from=1998, large_field=25)


@query("previous_editions", EDITIONS + """ select year, matches, lag(year) over (order by year) as previous_year,
    cast(matches - lag(matches) over (order by year) as bigint) as matches_delta from editions""")
def q_previous_editions(spark, sf):
    return X.previous_edition(editions(spark, sf)).select(
        "year", "matches", "previous_year", "matches_delta"
    )


@query("edition_ranks", FACTS + """, yearly as (
  select competition as year, stage, round(sum(regulation_home_goals + regulation_away_goals) / count(*), 2)
    as goals_per_match from facts where status = 'FINISHED' group by all)
  select stage, year, goals_per_match, cast(row_number() over (partition by stage
    order by goals_per_match desc, year) as integer) as goals_per_match_rank from yearly""")
def q_edition_ranks(spark, sf):
    """Editions ranked inside each stage."""
    goals = F.sum(F.col("regulation_home_goals") + F.col("regulation_away_goals"))
    yearly = (
        facts(spark, sf).where(X.finished())
        .groupBy("stage", F.col("competition").alias("year"))
        .agg(F.round(goals.cast("double") / F.count(F.lit(1)), 2).alias("goals_per_match"))
    )
    return with_edition_rank(yearly, ["stage"])
