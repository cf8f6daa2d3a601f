"""Match facts and the extracts that read them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import display
from ..plans import extracts as X
from ..plans.marts import fct_matches, latest_matches
from ..plans.staging import stage_matches
from .contests import BY, FACTS, facts, raw_matches, teams
from .registry import query

MATCH_COLUMNS = """competition, match_id, kickoff_at, status, matchday, stage, group_code, home_team_id,
 home_team_name, away_team_id, away_team_name, full_time_home_goals, full_time_away_goals,
 regulation_home_goals, regulation_away_goals, half_time_home_goals, half_time_away_goals,
 extra_time_home_goals, extra_time_away_goals, penalty_home_goals, penalty_away_goals, winner,
 duration, last_updated_at, snapshot_date"""

# Snapshots as staged: the fixture as first announced, and the state a day after kick-off.
SNAPSHOTS = FACTS + """, snapshots as (
  select *, snapshot_date as extraction_date from facts
  union all by name
  select competition, match_id, kickoff_at, 'TIMED' as status, matchday, stage, group_code, home_team_id,
         home_team_name, away_team_id, away_team_name, 'REGULAR' as duration, last_updated_at,
         cast(kickoff_at as date) as extraction_date
  from facts)"""

# Facts without what a card does not show, with the attributes of both teams looked up.
CARDS = FACTS + """, cards as (
  select f.* exclude (regulation_home_goals, regulation_away_goals, half_time_home_goals, half_time_away_goals,
      extra_time_home_goals, extra_time_away_goals, last_updated_at, snapshot_date)
    replace (f.regulation_home_goals as full_time_home_goals, f.regulation_away_goals as full_time_away_goals),
    (select team_tla from teams where team_id = f.home_team_id) as home_team_tla,
    (select team_tla from teams where team_id = f.away_team_id) as away_team_tla,
    (select team_crest_url from teams where team_id = f.home_team_id) as home_crest,
    (select team_crest_url from teams where team_id = f.away_team_id) as away_crest
  from facts f)"""

# Matches and goals by stage and status; totals of finished matches follow from it.
TALLY = FACTS + """, tally as (
  select competition, stage, status, count(*) as n,
    sum(case status when 'FINISHED' then coalesce(regulation_home_goals, 0) + coalesce(regulation_away_goals, 0) else 0 end) as g
  from facts group by all)"""


def cards(spark, sf):
    return X.match_cards(facts(spark, sf), teams(spark, sf), keep=BY)


@query("stage_matches", SNAPSHOTS + """
select competition, match_id, kickoff_at, status, matchday, stage, group_code, home_team_id, home_team_name,
  'N' || lpad(cast(home_team_id as varchar), 2, '0') as home_team_tla, away_team_id, away_team_name,
  'N' || lpad(cast(away_team_id as varchar), 2, '0') as away_team_tla, winner, duration,
  full_time_home_goals, full_time_away_goals, half_time_home_goals, half_time_away_goals,
  extra_time_home_goals, extra_time_away_goals, penalty_home_goals, penalty_away_goals,
  last_updated_at, extraction_date from snapshots""")
def q_stage_matches(spark, sf):
    return stage_matches(raw_matches(spark, sf), BY).drop("extracted_at")


@query("fct_matches", FACTS + f" select {MATCH_COLUMNS} from facts")
def q_fct_matches(spark, sf):
    staged = stage_matches(raw_matches(spark, sf), BY)
    return fct_matches(latest_matches(staged, BY), BY)


@query("match_cards", CARDS + " select * from cards")
def q_match_cards(spark, sf):
    return cards(spark, sf)


@query("latest_results", CARDS + """ from cards where status = 'FINISHED'
  qualify row_number() over (order by kickoff_at desc, match_id desc) < 9""")
def q_latest_results(spark, sf):
    return X.latest_results(cards(spark, sf))


@query("upcoming_matches", CARDS + """ from cards where status <> 'FINISHED'
  qualify row_number() over (order by kickoff_at, match_id) < 9""")
def q_upcoming(spark, sf):
    return X.upcoming_matches(cards(spark, sf))


@query("key_metrics", TALLY + """, ended as (select sum(n) as n, sum(g) as g from tally where status = 'FINISHED')
  select (select sum(n) from tally)::bigint as matches_total, coalesce(n, 0)::bigint as matches_played,
    g::bigint as goals_scored, (select count(*) from teams) as teams, round(g / n, 2) as avg_goals_per_match from ended""")
def q_key_metrics(spark, sf):
    return X.key_metrics(facts(spark, sf), teams(spark, sf))


@query("goals_by_stage", TALLY + """, named(stage, label, stage_order) as (values ('GROUP_STAGE', 'Groupes', 0), ('LAST_32', '16es', 1),
    ('LAST_16', '8es', 2), ('QUARTER_FINALS', 'Quarts', 3), ('SEMI_FINALS', 'Demies', 4), ('FINAL', 'Finale', 6)),
  ended as (select competition, stage, sum(n) as n, sum(g) as g from tally where status = 'FINISHED' group by all)
  select s.competition, s.stage, coalesce(n, 0)::bigint as matches, g::bigint as goals, round(g / n, 2) as avg_goals, label, stage_order
  from (select distinct competition, stage from tally) s left join ended e on e.competition = s.competition and e.stage = s.stage
  join named on named.stage = s.stage""")
def q_goals_by_stage(spark, sf):
    return X.goals_by_stage(facts(spark, sf), BY)


@query("scorelines", FACTS + """ select * from (
    select array_to_string(list_reverse_sort([regulation_home_goals, regulation_away_goals]), '–') as scoreline, count(*) as "count"
    from facts where status = 'FINISHED' and regulation_home_goals is not null group by 1)
  qualify row_number() over (order by "count" desc, scoreline) < 9""")
def q_scorelines(spark, sf):
    return X.scorelines(facts(spark, sf))


@query("results_split", FACTS + """, ends as (select competition, winner, count(*) as n from facts where status = 'FINISHED' group by all)
  select competition, coalesce(max(n) filter (where winner = 'HOME_TEAM'), 0) as home_wins,
    coalesce(max(n) filter (where winner = 'DRAW'), 0) as draws, coalesce(max(n) filter (where winner = 'AWAY_TEAM'), 0) as away_wins
  from ends group by competition""")
def q_results_split(spark, sf):
    return X.results_split(facts(spark, sf), BY)


@query("result_shares", FACTS + """, n as (select competition, winner, count(*) as n from facts
    where status = 'FINISHED' group by all)
  select competition, winner, n,
    round(n / sum(n) over (partition by competition), 6) as share_of_total,
    round(n / max(n) over (partition by competition), 6) as share_of_max from n""")
def q_result_shares(spark, sf):
    finished = facts(spark, sf).where(X.finished())
    counts = finished.groupBy(*BY, "winner").agg(F.count(F.lit(1)).alias("n"))
    return X.shares(counts, "n", BY)


@query("champion", CARDS + """ select competition, match_id, kickoff_at, status,
    case when status = 'FINISHED' then case when hw then home_team_name else away_team_name end end as team_name,
    case when status = 'FINISHED' then case when hw then home_crest else away_crest end end as crest,
    case when status = 'FINISHED' then case when hw then away_team_name else home_team_name end end as runner_up,
    case when status = 'FINISHED' then case when hw
      then full_time_home_goals || '–' || full_time_away_goals
      else full_time_away_goals || '–' || full_time_home_goals end end as final_score
  from (select *, coalesce(winner = 'HOME_TEAM', false) as hw,
          row_number() over (partition by competition order by kickoff_at desc, match_id desc) as rn
        from cards where stage = 'FINAL') where rn = 1""")
def q_champion(spark, sf):
    return X.champion(cards(spark, sf), BY)


@query("decided_matches", FACTS + """ select competition, match_id, stage, duration, winner,
    case winner when 'HOME_TEAM' then home_team_id else away_team_id end as winner_id,
    case winner when 'HOME_TEAM' then home_team_name else away_team_name end as winner_name,
    case winner when 'HOME_TEAM' then away_team_id else home_team_id end as loser_id,
    case winner when 'HOME_TEAM' then away_team_name else home_team_name end as loser_name,
    wg as winner_goals, lg as loser_goals, wk as winner_kicks, lk as loser_kicks,
    wg || '–' || lg || case when duration = 'PENALTY_SHOOTOUT' and wk is not null
      then ' (' || wk || '–' || lk || ' t.a.b.)' else '' end as score
  from (select *, case winner when 'HOME_TEAM' then regulation_home_goals else regulation_away_goals end as wg,
          case winner when 'HOME_TEAM' then regulation_away_goals else regulation_home_goals end as lg,
          case winner when 'HOME_TEAM' then penalty_home_goals else penalty_away_goals end as wk,
          case winner when 'HOME_TEAM' then penalty_away_goals else penalty_home_goals end as lk
        from facts where status = 'FINISHED' and winner in ('HOME_TEAM', 'AWAY_TEAM'))""")
def q_decided(spark, sf):
    return X.decided_teams(facts(spark, sf), BY)


@query("match_labels", FACTS + """ select match_id,
    cast(extract(day from kickoff_at) as varchar) || ' ' ||
      (['JANV','FÉVR','MARS','AVR','MAI','JUIN','JUIL','AOÛT','SEPT','OCT','NOV','DÉC'])[month(kickoff_at)]
      || ' · ' || strftime(kickoff_at, '%H:%M') as kickoff,
    strftime(last_updated_at, '%Y-%m-%d %H:%M UTC') as stamp,
    coalesce(regulation_home_goals || '–' || regulation_away_goals, '–') as score,
    penalty_home_goals || '–' || penalty_away_goals || ' t.a.b.' as shootout,
    case stage when 'GROUP_STAGE' then 'Phase de groupes' when 'LAST_32' then '16es de finale'
      when 'LAST_16' then '8es de finale' when 'QUARTER_FINALS' then 'Quarts de finale'
      when 'SEMI_FINALS' then 'Demi-finales' when 'FINAL' then 'Finale' end as stage_name,
    'Groupe ' || group_code as group_label,
    case when regulation_home_goals - regulation_away_goals > 0 then '+' else '' end
      || (regulation_home_goals - regulation_away_goals) as difference,
    upper(substr(home_team_name, 1, 3)) as short_home
  from facts""")
def q_match_labels(spark, sf):
    home, away = F.col("regulation_home_goals"), F.col("regulation_away_goals")
    return facts(spark, sf).select(
        "match_id", display.kickoff(F.col("kickoff_at")).alias("kickoff"),
        display.stamp(F.col("last_updated_at")).alias("stamp"),
        display.score_or_dash(home, away).alias("score"),
        display.shootout_text(F.col("penalty_home_goals"), F.col("penalty_away_goals")).alias("shootout"),
        display.stage_name(F.col("stage")).alias("stage_name"),
        display.group_label(F.col("group_code")).alias("group_label"),
        display.signed(home - away).alias("difference"),
        display.short_label(F.col("home_team_name")).alias("short_home"),
    )
