"""Rating model: expected goals and points, strength, upsets, paths, comparisons."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ranking import chronological, top_k
from ..operators.reshape import match_sides
from ..plans import profiles as P
from ..plans import ratings as R
from ..plans.extracts import champion_on_podium
from .contests import BY, FACTS, facts, fixed_ratings, teams
from .registry import query, table

# Expected goals and outcome probabilities over finished matches with fixed ratings; the
# probabilities come from the explicit 11 x 11 grid of scores.
ODDS = FACTS + """, factorials as (
  select k, (case when k = 0 then 1 else (list_product(range(1, k + 1))) end)::double as f from range(0, 11) t(k)
), rated as (
  select f.*, h.rating as home_rating, a.rating as away_rating,
    exp(case when f.stage = 'GROUP_STAGE' then 0.25::double else 0 end + h.attack - a.defense) as xg_home,
    exp(a.attack - h.defense) as xg_away
  from facts f join fixed_ratings h on h.team_id = f.home_team_id
  join fixed_ratings a on a.team_id = f.away_team_id
  where f.status = 'FINISHED' and f.regulation_home_goals is not null
), pairs as (select distinct xg_home, xg_away from rated),
grid as (
  select p.xg_home, p.xg_away, i.k as i, j.k as j,
    exp(-p.xg_home) * pow(p.xg_home, i.k) / i.f * exp(-p.xg_away) * pow(p.xg_away, j.k) / j.f as p
  from pairs p, factorials i, factorials j
), probs as (
  select xg_home, xg_away, sum(p) filter (where i > j) / sum(p) as p_home,
    sum(p) filter (where i = j) / sum(p) as p_draw, sum(p) filter (where i < j) / sum(p) as p_away
  from grid group by all
), odds as (select r.*, p.p_home, p.p_draw, p.p_away from rated r join probs p using (xg_home, xg_away))"""

MODEL_LEGS = ODDS + """, model_legs as (
  select competition, match_id, kickoff_at, stage, home_team_id as team_id, away_team_id as opponent_id,
    away_team_name as opponent, regulation_home_goals as gf, regulation_away_goals as ga,
    xg_home as xgf, xg_away as xga, 3 * p_home + p_draw as xp, away_rating as opp, p_home as win_prob,
    case winner when 'HOME_TEAM' then 3 when 'DRAW' then 1 else 0 end as pts,
    case winner when 'HOME_TEAM' then 'V' when 'DRAW' then 'N' else 'D' end as result,
    duration, penalty_home_goals as kf, penalty_away_goals as ka from odds
  union all
  select competition, match_id, kickoff_at, stage, away_team_id, home_team_id, home_team_name,
    regulation_away_goals, regulation_home_goals, xg_away, xg_home, 3 * p_away + p_draw, home_rating, p_away,
    case winner when 'AWAY_TEAM' then 3 when 'DRAW' then 1 else 0 end,
    case winner when 'AWAY_TEAM' then 'V' when 'DRAW' then 'N' else 'D' end,
    duration, penalty_away_goals, penalty_home_goals from odds)"""

STRENGTH = MODEL_LEGS + """, sums as (
  select competition, team_id, count(*) as played, cast(sum(gf) as bigint) as goals_for,
    cast(sum(ga) as bigint) as goals_against, sum(xgf) as xgf, sum(xga) as xga, cast(sum(pts) as bigint) as points,
    sum(xp) as xp, sum(opp) as opp from model_legs group by all
), members as (
  select distinct competition, home_team_id as team_id from facts
  union select distinct competition, away_team_id from facts
), strength as (
  select m.competition, m.team_id, t.team_name, t.team_tla, t.team_crest_url as crest,
    round(r.attack, 3) as attack, round(r.defense, 3) as defense, round(r.rating, 3) as rating,
    row_number() over (partition by m.competition order by r.rating desc, m.team_id) as rank_overall,
    row_number() over (partition by m.competition order by r.attack desc, m.team_id) as rank_attack,
    row_number() over (partition by m.competition order by r.defense desc, m.team_id) as rank_defense,
    coalesce(s.played, 0) as played, coalesce(s.goals_for, 0) as goals_for,
    coalesce(s.goals_against, 0) as goals_against, round(coalesce(s.xgf, 0), 2) as xgf,
    round(coalesce(s.xga, 0), 2) as xga, coalesce(s.points, 0) as points, round(coalesce(s.xp, 0), 2) as xpoints,
    round(coalesce(s.points, 0) - coalesce(s.xp, 0), 2) as performance,
    case when s.played > 0 then round(s.opp / s.played, 3) else 0 end as sos
  from members m join teams t using (team_id) join fixed_ratings r using (team_id)
  left join sums s on s.competition = m.competition and s.team_id = m.team_id)"""


def members(match_facts):
    """Teams of every competition."""
    return match_sides(
        match_facts, home={"team_id": "home_team_id"}, away={"team_id": "away_team_id"}, keep=BY
    ).distinct()


def odds(spark, sf):
    return P.match_odds(facts(spark, sf), fixed_ratings(teams(spark, sf)), ())


def yearly_teams(spark, sf):
    """Team attributes per competition."""
    return members(facts(spark, sf)).join(teams(spark, sf), "team_id")


def strength(spark, sf):
    all_facts, yearly = facts(spark, sf), yearly_teams(spark, sf)
    return R.team_strength(all_facts, fixed_ratings(yearly, *BY), yearly, BY)


@query("outcome_probabilities", ODDS + """ select match_id, round(xg_home, 6) as xg_home, round(xg_away, 6) as xg_away,
    round(p_home, 6) as p_home, round(p_draw, 6) as p_draw, round(p_away, 6) as p_away from odds""")
def q_outcomes(spark, sf):
    rows = odds(spark, sf)
    return rows.select(
        "match_id", *[F.round(c, 6).alias(c) for c in ("xg_home", "xg_away", "p_home", "p_draw", "p_away")]
    )


@query("team_strength", STRENGTH + " select * from strength")
def q_strength(spark, sf):
    return strength(spark, sf)


@query("rating_ranks_distributed", FACTS + """, members as (
    select distinct competition, home_team_id as team_id from facts
    union select distinct competition, away_team_id from facts)
  select competition, team_id,
    row_number() over (partition by competition order by rating desc, team_id) as rank_overall,
    row_number() over (partition by competition order by attack desc, team_id) as rank_attack,
    row_number() over (partition by competition order by defense desc, team_id) as rank_defense
  from members join fixed_ratings using (team_id)""")
def q_rating_ranks(spark, sf):
    rated = fixed_ratings(members(facts(spark, sf)), *BY)
    return R.with_rating_ranks(rated, BY, bounded_fields=False).select(
        *BY, "team_id", "rank_overall", "rank_attack", "rank_defense")


@query("upsets", ODDS + """ select match_id, stage, winner_name, loser_name,
    wg || '–' || lg || case when duration = 'PENALTY_SHOOTOUT' then ' (' || wk || '–' || lk || ' t.a.b.)' else '' end as score,
    round(p, 3) as win_prob
  from (select *, case when winner = 'HOME_TEAM' then p_home else p_away end as p,
      case when winner = 'HOME_TEAM' then home_team_name else away_team_name end as winner_name,
      case when winner = 'HOME_TEAM' then away_team_name else home_team_name end as loser_name,
      case when winner = 'HOME_TEAM' then regulation_home_goals else regulation_away_goals end as wg,
      case when winner = 'HOME_TEAM' then regulation_away_goals else regulation_home_goals end as lg,
      case when winner = 'HOME_TEAM' then penalty_home_goals else penalty_away_goals end as wk,
      case when winner = 'HOME_TEAM' then penalty_away_goals else penalty_home_goals end as lk
    from odds where winner in ('HOME_TEAM', 'AWAY_TEAM'))
  order by win_prob, match_id limit 8""")
def q_upsets(spark, sf):
    return P.upsets(odds(spark, sf))


@query("marquee_upset", ODDS + """, likely as (
    select match_id, case when winner = 'HOME_TEAM' then away_team_name else home_team_name end as loser_name,
      round(case when winner = 'HOME_TEAM' then p_home else p_away end, 3) as win_prob
    from odds where winner in ('HOME_TEAM', 'AWAY_TEAM')),
  worst as (select * from likely)
  select match_id, loser_name, win_prob from worst
  order by case when loser_name = 'NATION_24' then 0 else 1 end, win_prob, match_id limit 1""")
def q_marquee(spark, sf):
    return P.marquee_upset(odds(spark, sf), "nation_24").select("match_id", "loser_name", "win_prob")


PATHS = MODEL_LEGS + """, paths as (
  select competition, match_id, kickoff_at, stage, team_id, opponent_id, opponent,
    gf || '–' || ga || case when duration = 'PENALTY_SHOOTOUT' and kf is not null
      then ' (' || kf || '–' || ka || ' t.a.b.)' else '' end as score,
    result, round(win_prob, 3) as win_prob, round(xgf, 2) as model_xg_for, round(xga, 2) as model_xg_against
  from model_legs)"""


def paths(spark, sf, subject=None):
    rated = P.match_odds(facts(spark, sf), fixed_ratings(teams(spark, sf)), ())
    return P.team_paths(rated, BY, subject)


@query("team_paths", PATHS + " select * from paths")
def q_paths(spark, sf):
    return paths(spark, sf)


@query("entity_path", PATHS + """ select *, row_number() over (partition by competition
    order by kickoff_at, match_id) as step from paths where team_id = 7""")
def q_entity_path(spark, sf):
    return chronological(paths(spark, sf, F.lit(7)), BY, P.path_order())


@query("closest_matches", PATHS + """ select competition, team_id, match_id, stage, opponent, score, result, win_prob
  from (select *, row_number() over (partition by competition, team_id order by win_prob, kickoff_at, match_id) as rn
    from paths) where rn = 1""")
def q_closest(spark, sf):
    return P.closest_match(paths(spark, sf), BY)


@query("over_under_performance", STRENGTH + """, gaps as (
    select competition, team_id, team_name, played, points, xpoints, round(points - xpoints, 2) as gap
    from strength where played >= 3), placed as (
    select *, row_number() over (partition by competition order by gap desc, team_id) as performance_rank,
      row_number() over (partition by competition order by abs(gap) desc, team_id) as size_rank from gaps)
  select competition, team_id, team_name, played, points, xpoints, gap, performance_rank
  from placed where size_rank <= 10""")
def q_over_under(spark, sf):
    return P.over_under(strength(spark, sf), BY)


@query("scatter_labels", STRENGTH + """ select competition, team_id, team_name, attack, defense,
    rank_overall <= 5 or rank_attack = 1 or rank_defense = max(rank_defense) over (partition by competition) as show
  from strength""")
def q_scatter(spark, sf):
    return P.scatter_labels(strength(spark, sf), BY)


@query("rating_vs_finish", FACTS + """, seen as (
    select competition, home_team_id as team_id, stage from facts
    union all select competition, away_team_id, stage from facts)
  select s.competition, s.team_id, t.team_name, t.team_tla, round(r.rating, 3) as rating,
    cast(max(case stage when 'LAST_32' then 1 when 'LAST_16' then 2 when 'QUARTER_FINALS' then 3
      when 'SEMI_FINALS' then 4 when 'THIRD_PLACE' then 4 when 'FINAL' then 5 else 0 end) as integer) as finish,
    lower(t.team_name) = 'nation_7' as highlight
  from seen s join teams t using (team_id) join fixed_ratings r using (team_id) group by all""")
def q_rating_vs_finish(spark, sf):
    yearly = yearly_teams(spark, sf)
    return P.rating_vs_finish(facts(spark, sf), fixed_ratings(yearly, *BY), yearly, BY, "nation_7")


@query("entity_case", STRENGTH + """, placed as (
    select competition, team_id, round(rating, 4) as title_prob,
      row_number() over (partition by competition order by rating desc, team_id) as title_rank from strength)
  select s.competition, s.team_id, s.team_name, crest, rank_overall, rank_attack, rank_defense, goals_for, xgf,
    goals_against, xga, points, xpoints, performance,
    count(*) over (partition by s.competition) as n_teams, p.title_prob, p.title_rank
  from strength s join placed p on p.competition = s.competition and p.team_id = s.team_id
  qualify lower(s.team_name) = 'nation_7'""")
def q_entity_case(spark, sf):
    table_ = strength(spark, sf)
    chances = table_.select(*BY, "team_id", F.col("rating").alias("title_prob"))
    return P.entity_case(table_, chances, BY, "nation_7")


# Measured statistics per nation from its own customers' orders.
REALITY = """, reality as (
  select n_name as team_name, round(avg(o_totalprice), 4) as save_pct, count(*) as shots
  from orders join customer on o_custkey = c_custkey join nation on n_nationkey = c_nationkey group by n_name)"""


def reality(spark, sf):
    joined = (
        table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return joined.groupBy(F.col("n_name").alias("team_name")).agg(
        F.round(F.avg("o_totalprice"), 4).alias("save_pct"), F.count(F.lit(1)).alias("shots")
    )


@query("model_reality_correlation", STRENGTH + REALITY + """
  select competition, round(corr(defense, save_pct), 4) as r, round(avg(save_pct), 4) as avg_save_pct, count(*) as n
  from strength join reality using (team_name) group by competition""")
def q_correlation(spark, sf):
    joined = strength(spark, sf).join(reality(spark, sf), "team_name")
    return P.correlation(joined, "defense", "save_pct", BY)


MEASURED = """, measured as (
  select cast(year(o_orderdate) as integer) as competition, n_name as team_name, round(max(o_totalprice), 2) as possession,
    count(*)::integer as shots, count(*) filter (where o_orderstatus = 'F')::integer as sot, max(o_orderkey)::integer as sota,
    count(distinct o_custkey)::integer as ga, round(min(o_totalprice), 2) as save_pct, count(*) filter (where o_orderstatus = 'O')::integer as cs
  from orders join customer on o_custkey = c_custkey join nation on n_nationkey = c_nationkey group by all)"""


@query("team_reality", STRENGTH + MEASURED + """
  select competition, team_id, team_name, team_tla, crest, rank_overall, rank_attack, rank_defense, attack, defense, rating,
    possession, shots, sot, round(sot / shots, 4) as sot_pct, sota, ga, save_pct, cs, round(ga / shots, 4) as conversion
  from strength join measured using (competition, team_name)""")
def q_team_reality(spark, sf):
    """Ratings beside what was measured of each nation in its year; one nation is spelled otherwise there."""
    joined = (
        table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    spelled = F.when(F.col("n_name") == "NATION_7", "Nation Seven").otherwise(F.col("n_name")).alias("team")
    n = F.count(F.lit(1)).cast("int")
    measured = joined.groupBy(F.year("o_orderdate").alias("competition"), spelled).agg(
        F.round(F.max("o_totalprice"), 2).alias("possession"), n.alias("shots"), F.count_if(F.col("o_orderstatus") == "F").cast("int").alias("sot"),
        F.max("o_orderkey").cast("int").alias("sota"), F.countDistinct("o_custkey").cast("int").alias("ga"),
        F.round(F.min("o_totalprice"), 2).alias("save_pct"), F.count_if(F.col("o_orderstatus") == "O").cast("int").alias("cs"),
    ).withColumns({"sot_pct": F.round(F.col("sot") / F.col("shots"), 4), "g_per_sh": F.round(F.col("ga") / F.col("shots"), 4)})
    return P.team_reality(strength(spark, sf), measured, BY, {"Nation Seven": "NATION_7"})


@query("real_vs_model", PATHS + """, own as (
    select match_id, regulation_home_goals as f, regulation_away_goals as a, full_time_home_goals as s from facts where home_team_id = 7
    union all select match_id, regulation_away_goals, regulation_home_goals, full_time_away_goals from facts where away_team_id = 7)
  select row_number() over (order by kickoff_at, match_id) as step, stage, opponent, score, null::double as possession, f::double as xg_for,
    a::double as xg_against, s::double as shots, null::double as sot, null::double as big_chances, model_xg_for, model_xg_against
  from paths join own using (match_id) where team_id = 7""")
def q_real_vs_model(spark, sf):
    """Every match of one nation beside its measured statistics, paired by time; unequal lengths would stop the query."""
    played = R.finished_with_score(facts(spark, sf)).where("home_team_id = 7 or away_team_id = 7")
    events = played.select(
        F.col("match_id").alias("id"), F.unix_seconds(F.col("kickoff_at").cast("timestamp")).alias("startTimestamp"),
        F.struct(F.col("home_team_name").alias("name")).alias("homeTeam"))

    def item(name, what):
        return F.struct(F.lit(name).alias("name"), *[F.col(f"{what}_{s}_goals").cast("string").alias(s) for s in ("home", "away")])

    items = F.array(item("Expected goals", "regulation"), item("Total shots", "full_time"))
    groups = F.array(F.struct(items.alias("statisticsItems")))
    statistics = played.select(
        F.col("match_id").cast("string").alias("id"), F.struct(F.array(F.struct(groups.alias("groups"))).alias("statistics")).alias("value"))
    return P.real_vs_model(paths(spark, sf, F.lit(7)), events, statistics, "NATION_7")


@query("holds_maximum", STRENGTH + """ select competition, team_name,
    points = max(points) over (partition by competition) as has_top from strength""")
def q_holds_maximum(spark, sf):
    return P.holds_maximum(strength(spark, sf), "points", "team_name", BY)


@query("shot_summary", """select l_orderkey, count(*) as shots, round(sum(round(l_discount, 3)), 3) as xg,
    count(*) filter (where l_returnflag = 'R') as goals from lineitem group by l_orderkey""")
def q_shot_summary(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", F.round("l_discount", 3).alias("xg"), (F.col("l_returnflag") == "R").alias("goals")
    ).withColumnRenamed("goals", "goal")
    return P.shot_summary(rows, ["l_orderkey"])


@query("poisson_fit")
def q_poisson_fit(spark, sf):
    """Ratings of every competition fitted to its finished matches."""
    fitted = R.fit_ratings(model_input(spark, sf), BY)
    return fitted.select(
        *BY, "team_id", *[F.round(c, 4).alias(c) for c in ("attack", "defense", "rating", "home_adv")],
        F.round("final_nll", 3).alias("final_nll"), "n_matches",
    )


def model_input(spark, sf):
    return R.finished_with_score(facts(spark, sf)).select(
        *BY, "match_id", "home_team_id", "away_team_id", "home_team_name", "away_team_name",
        F.col("regulation_home_goals").alias("home_goals"), F.col("regulation_away_goals").alias("away_goals"),
    )


@query("fit_metadata")
def q_fit_metadata(spark, sf):
    return R.fit_metadata(R.fit_ratings(model_input(spark, sf), BY), BY)


SIDES = FACTS + """, sides as (
    select competition, home_team_id as team_id, regulation_home_goals as f, regulation_away_goals as a from facts where status = 'FINISHED'
    union all select competition, away_team_id, regulation_away_goals, regulation_home_goals from facts where status = 'FINISHED')
  select """
BALANCE = "team_id, sum(f)::double as scored, sum(a)::double as conceded from sides group by all"


@query("fit_balance", SIDES + "competition, " + BALANCE)
def q_fit_balance(spark, sf):
    """At the optimum the fit's goals, with the ridge's share, equal those of the matches."""
    return R.fit_balance(model_input(spark, sf), BY)


@query("fit_balance_in_passes", SIDES + "competition, " + BALANCE)
def q_fit_balance_in_passes(spark, sf):
    """The same, fitted by passes of joins and aggregates."""
    return R.fit_balance(model_input(spark, sf), BY, solver="blocks")


@query("fit_balance_one_field", SIDES + BALANCE)
def q_fit_balance_one_field(spark, sf):
    """All years as one competition, fitted by passes of joins and aggregates."""
    return R.fit_balance(model_input(spark, sf), (), solver="blocks")


@query("fit_counts", FACTS + """, ids as (
    select competition, home_team_id as id, match_id from facts where status = 'FINISHED'
    union all select competition, away_team_id, match_id from facts where status = 'FINISHED')
  select competition, count(distinct id) as n_teams, count(distinct match_id) as n_matches, 0.05::double as ridge from ids group by all""")
def q_fit_counts(spark, sf):
    """The columns of the fit's metadata that a count can check."""
    return R.fit_metadata(R.fit_ratings(model_input(spark, sf), BY), BY).select(*BY, "n_teams", "n_matches", F.col("ridge").cast("double"))


@query("model_input_pairs", FACTS + """ select competition, home_team_id as home, away_team_id as away, count(*) as n,
    cast(sum(regulation_home_goals) as bigint) as home_goals, cast(sum(regulation_away_goals) as bigint) as away_goals
  from facts where status = 'FINISHED' group by all""")
def q_pairs(spark, sf):
    return R.pair_results(model_input(spark, sf), BY)


@query("first_seen_names", FACTS + """, seen as (
    select competition, match_id, home_team_id as team_id, home_team_name as name from facts where status = 'FINISHED'
    union all select competition, match_id, away_team_id, away_team_name from facts where status = 'FINISHED')
  select competition, team_id, arg_min(name, match_id) as team_name from seen group by all""")
def q_first_seen(spark, sf):
    return R.team_names(model_input(spark, sf), BY)


@query("champion_on_podium", """with spend as (
    select c_name as player_name, n_name as team_name, row_number() over (order by c_acctbal desc, c_custkey) as rank
    from customer join nation on n_nationkey = c_nationkey), three as (select * from spend where rank <= 3)
  select (select team_name from spend where rank = 2) as champion_name,
    (select player_name from three where rank = 1) as golden_boot,
    (select count(*) from three where team_name = (select team_name from spend where rank = 2)) > 0 as on_podium""")
def q_podium(spark, sf):
    order = [F.col("c_acctbal").desc(), F.col("c_custkey").asc()]
    named = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    three = top_k(named, order, 3).withColumn("rank", F.row_number().over(W.orderBy(*order)))  # three rows
    leaders = three.select("rank", F.col("c_name").alias("player_name"), F.col("n_name").alias("team_name"))
    return champion_on_podium(leaders, leaders.where("rank = 2").select("team_name"))
