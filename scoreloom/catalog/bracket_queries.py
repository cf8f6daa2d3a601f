"""Knockout trees: one per competition, seeded by the results of its year."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import materialise
from ..operators.ranking import top_k_per_key
from ..operators.reshape import goal_legs, match_sides
from ..plans import bracket as B
from ..plans import profiles as P
from ..plans.extracts import bracket_nested, finished
from .contests import BY, FACTS, LEGS, facts, fixed_ratings, teams
from .registry import query

ROUNDS = (("LAST_16", 16), ("QUARTER_FINALS", 8), ("SEMI_FINALS", 4), ("FINAL", 2))


def seeds(spark, sf):
    """The sixteen best nations of every year, by results of all finished matches."""
    legs = goal_legs(
        facts(spark, sf).where(finished()), BY, "regulation_home_goals", "regulation_away_goals"
    )
    totals = legs.groupBy(*BY, "team_id").agg(
        F.sum(F.when(F.col("scored") > F.col("conceded"), 3).when(F.col("scored") == F.col("conceded"), 1)
              .otherwise(0)).alias("points"),
        F.sum(F.col("scored") - F.col("conceded")).alias("gd"),
        F.sum("scored").alias("gf"),
    )
    order = [F.col("points").desc(), F.col("gd").desc(), F.col("gf").desc(), F.col("team_id").asc()]
    return materialise(top_k_per_key(totals, BY, order, 16, "seed").select(*BY, "seed", "team_id"))


def knockout(best):
    """Four rounds in which the better seed always goes through (seed i meets n + 1 - i)."""
    rounds = F.array(*[
        F.struct(F.lit(i).alias("no"), F.lit(stage).alias("stage"), F.lit(n).alias("field"))
        for i, (stage, n) in enumerate(ROUNDS)
    ])
    homes = best.select(
        *BY, F.col("seed").alias("home_seed"), F.col("team_id").alias("home_team_id"), F.explode(rounds).alias("r")
    ).where(F.col("home_seed") * 2 <= F.col("r.field"))
    aways = best.select(*BY, F.col("seed").alias("_seed"), F.col("team_id").alias("away_team_id"))
    paired = homes.withColumn("_seed", F.col("r.field") + 1 - F.col("home_seed")).join(aways, [*BY, "_seed"])
    match_id = F.col("competition").cast("long") * 100 + F.col("r.no") * 10 + F.col("home_seed")
    return paired.select(
        *BY, match_id.alias("match_id"), F.col("r.stage").alias("stage"), "home_team_id", "away_team_id",
        F.lit("HOME_TEAM").alias("winner"),
    )


SEEDS = FACTS + LEGS + """, totals as (
  select competition, team_id, sum(case when rs > rc then 3 when rs = rc then 1 else 0 end) as points,
    sum(rs - rc) as gd, sum(rs) as gf from legs group by all
), seeds as (
  select * from (select competition, team_id, row_number() over (partition by competition
    order by points desc, gd desc, gf desc, team_id) as seed from totals) where seed <= 16
), rounds as (select * from (values (0, 'LAST_16', 16), (1, 'QUARTER_FINALS', 8), (2, 'SEMI_FINALS', 4), (3, 'FINAL', 2))
    r(no, stage, field)
), knockout as (
  select h.competition, cast(h.competition as bigint) * 100 + r.no * 10 + h.seed as match_id, r.no, r.field,
    h.seed as hs, h.team_id as home_team_id, a.team_id as away_team_id
  from rounds r join seeds h on h.seed * 2 <= r.field
  join seeds a on a.competition = h.competition and a.seed = r.field + 1 - h.seed)"""

# P(team i beats team j) at a neutral venue from the fixed ratings.
WIN = """, factorials as (
  select k, (case when k = 0 then 1 else list_product(range(1, k + 1)) end)::double as f from range(0, 11) t(k)
), rates as (
  select i.team_id as i, j.team_id as j, exp(i.attack - j.defense) as li, exp(j.attack - i.defense) as lj
  from fixed_ratings i join fixed_ratings j on i.team_id <> j.team_id
), grid as (
  select r.i, r.j, x.k as x, y.k as y,
    exp(-li) * pow(li, x.k) / x.f * exp(-lj) * pow(lj, y.k) / y.f as p
  from rates r, factorials x, factorials y
), win as (
  select i, j, (sum(p) filter (where x > y) + sum(p) filter (where x = y) / 2) / sum(p) as w from grid group by i, j)"""


def _round_sql(no: int, n: int) -> str:
    """Distribution of the winner of each match of a round from the round before."""
    if no == 0:
        place = "select competition, hs as m, 0 as slot, home_team_id as team_id, 1.0::double as p from knockout where no = 0 " \
                "union all select competition, hs, 1, away_team_id, 1.0 from knockout where no = 0"
    else:
        place = f"select competition, case when m <= {n // 2} then m else {n} + 1 - m end as m, " \
                f"case when m <= {n // 2} then 0 else 1 end as slot, team_id, p from dist{no - 1}"
    return f""", place{no} as ({place}), dist{no} as (
  select a.competition, a.m, a.team_id, a.p * sum(b.p * w.w) as p
  from place{no} a join place{no} b on b.competition = a.competition and b.m = a.m and b.slot <> a.slot
  join win w on w.i = a.team_id and w.j = b.team_id group by a.competition, a.m, a.team_id, a.p)"""


DISTRIBUTIONS = SEEDS + WIN + "".join(_round_sql(i, n) for i, (_, n) in enumerate(ROUNDS))


@query("bracket_nodes", SEEDS + """ select competition, match_id, cast(no + 1 as integer) as round_idx, home_team_id, away_team_id,
    case when no > 0 then competition * 100 + (no - 1) * 10 + hs end as home_feeder,
    case when no > 0 then competition * 100 + (no - 1) * 10 + field + 1 - hs end as away_feeder from knockout""")
def q_bracket_nodes(spark, sf):
    return B.bracket_nodes(knockout(seeds(spark, sf)), BY)


@query("bracket_edges", SEEDS + """ select competition, match_id as parent_match_id, cast(no + 1 as integer) as round_idx,
    cast(0 as integer) as slot, competition * 100 + (no - 1) * 10 + hs as child_match_id from knockout where no > 0
  union all
  select competition, match_id, cast(no + 1 as integer), 1, competition * 100 + (no - 1) * 10 + field + 1 - hs
  from knockout where no > 0""")
def q_bracket_edges(spark, sf):
    return B.bracket_edges(B.bracket_nodes(knockout(seeds(spark, sf)), BY), BY)


@query("bracket_documents", SEEDS + """ select competition,
    (['LAST_16', 'QUARTER_FINALS', 'SEMI_FINALS', 'FINAL'])[no + 1] as stage, cast(([2, 3, 4, 6])[no + 1] as integer) as stage_order,
    (['Round of 16', 'Quarter-finals', 'Semi-finals', 'Final'])[no + 1] as label, count(*) as n_matches,
    string_agg(cast(match_id as varchar), ',' order by match_id) as match_ids
  from knockout group by competition, no""")
def q_bracket_documents(spark, sf):
    """The nested rounds (at most eight matches), shown by their size and the order of their matches."""
    kickoff = F.make_timestamp_ntz(F.col("competition"), F.lit(12), F.lit(1), F.lit(20), F.lit(0), F.lit(0))
    cards = knockout(seeds(spark, sf)).withColumn("kickoff_at", kickoff)
    ids = F.transform("matches", lambda m: m["match_id"].cast("string"))
    return bracket_nested(cards, BY).select(
        "competition", "stage", "stage_order", "label",
        F.size("matches").cast("long").alias("n_matches"), F.array_join(ids, ",").alias("match_ids"),
    )


def advance(best):
    nodes = B.bracket_nodes(knockout(best), BY)
    return B.advancement(nodes, fixed_ratings(best, *BY), BY)


@query("advancement", DISTRIBUTIONS + """ select s.competition, s.team_id, 1.0::double as reach_0,
    round(coalesce(d0.p, 0), 6) as reach_1, round(coalesce(d0.p, 0), 6) as reach_2, round(coalesce(d1.p, 0), 6) as reach_3,
    round(coalesce(d2.p, 0), 6) as reach_4, round(coalesce(d3.p, 0), 6) as reach_5
  from seeds s left join dist0 d0 using (competition, team_id) left join dist1 d1 using (competition, team_id)
  left join dist2 d2 using (competition, team_id) left join dist3 d3 using (competition, team_id)""")
def q_advancement(spark, sf):
    return advance(seeds(spark, sf)).select(
        *BY, "team_id", *[F.round(F.get("reach", F.lit(i)), 6).alias(f"reach_{i}") for i in range(6)]
    )


@query("title_odds", DISTRIBUTIONS + """, ranked as (
    select competition, team_id, p, row_number() over (partition by competition order by p desc, team_id) as n from dist3)
  select r.competition, r.team_id, t.team_name, t.team_tla, t.team_crest_url as crest, round(p, 4) as title_prob,
    cast(n as integer) as title_rank from ranked r join teams t using (team_id) where n <= 12""")
def q_title_odds(spark, sf):
    best = seeds(spark, sf)
    return B.title_odds(advance(best), best.join(teams(spark, sf), "team_id"), BY).drop("reach")


@query("title_progression", DISTRIBUTIONS + """, ranked as (
    select competition, team_id, p, cast(row_number() over (partition by competition order by p desc, team_id) as integer) as title_rank from dist3),
  levels as (select r.*, unnest([1.0::double, d0.p, d0.p, d1.p, d2.p, r.p]) as probability, unnest(range(6)) as k
    from ranked r join dist0 d0 using (competition, team_id) join dist1 d1 using (competition, team_id) join dist2 d2 using (competition, team_id)
    where title_rank <= 12)
  select competition, team_id, team_name, title_rank, cast(k as integer) as level_order,
    (['Entrée', '8es', 'Quarts', 'Demies', 'Finale', 'Titre'])[k + 1] as level, round(probability, 3) as probability
  from levels join teams using (team_id)""")
def q_title_progression(spark, sf):
    best = seeds(spark, sf)
    return B.title_progression(B.title_odds(advance(best), best.join(teams(spark, sf), "team_id"), BY), BY)


@query("win_table", SEEDS + WIN + """ select a.competition, w.i as team_id, w.j as opponent_id, round(w.w, 6) as win_prob
  from win w join seeds a on a.team_id = w.i join seeds b on b.team_id = w.j and b.competition = a.competition""")
def q_win_table(spark, sf):
    best = seeds(spark, sf)
    nodes = B.bracket_nodes(knockout(best), BY)
    rows = B.win_table(nodes, fixed_ratings(best, *BY), BY)
    return rows.withColumn("win_prob", F.round("win_prob", 6))


@query("runner_up_ratio", DISTRIBUTIONS + """, ranked as (
    select competition, p, row_number() over (partition by competition order by p desc, team_id) as n from dist3)
  select a.competition, cast(round(a.p / b.p) as bigint) as ratio from ranked a join ranked b using (competition)
  where a.n = 1 and b.n = 2""")
def q_runner_up(spark, sf):
    return P.runner_up_ratio(advance(seeds(spark, sf)), BY)


@query("bracket_from_results", FACTS + """ select competition, 1::double as total from facts where stage = 'FINAL' group by competition""")
def q_bracket_from_results(spark, sf):
    """Title chances of all teams in the trees that the real knockout results give; they add up to one."""
    rows = facts(spark, sf)
    nodes = materialise(B.bracket_nodes(rows, BY))
    members = match_sides(rows, home={"team_id": "home_team_id"}, away={"team_id": "away_team_id"}, keep=BY).distinct()
    chances = B.advancement(nodes, fixed_ratings(members, *BY), BY)
    return chances.groupBy(*BY).agg(F.round(F.sum("title_prob"), 9).alias("total"))


# The trees of the played knockout matches: any side can win, a side may have no earlier match, a
# competition may have many finals (its first counts), and a match may feed two others.
PLAYED = FACTS + """, played as (
  select competition, match_id, (list_position(['LAST_32', 'LAST_16', 'QUARTER_FINALS', 'SEMI_FINALS', 'FINAL'], stage) - 1)::integer as round_idx,
    home_team_id, away_team_id, case winner when 'HOME_TEAM' then home_team_id when 'AWAY_TEAM' then away_team_id end as won
  from facts where stage <> 'GROUP_STAGE'
), feeders as (
  select competition, round_idx + 1 as round_idx, won as team_id, max(match_id) as fed from played where won is not null group by all
), nodes as (
  select p.competition, p.match_id, p.round_idx, p.home_team_id, p.away_team_id,
    case when a.fed is not null then h.fed end as home_feeder, case when h.fed is not null then a.fed end as away_feeder
  from played p
  left join feeders h on h.competition = p.competition and h.round_idx = p.round_idx and h.team_id = p.home_team_id
  left join feeders a on a.competition = p.competition and a.round_idx = p.round_idx and a.team_id = p.away_team_id
), links as (
  select competition, match_id, 0 as slot, home_feeder as child from nodes where home_feeder is not null
  union all select competition, match_id, 1, away_feeder from nodes where away_feeder is not null)"""

# Places in each tree (1 is the final), and the teams that enter at its leaves.
ENTRANTS = PLAYED + """, place4 as (
  select competition, min(match_id) as match_id, 1 as place from nodes where round_idx = 4 group by competition
)""" + "".join(f""", place{r} as (
  select competition, l.child as match_id, p.place * 2 + l.slot as place from place{r + 1} p join links l using (competition, match_id)
)""" for r in (3, 2, 1, 0)) + """, entrants as (
  select competition, place, round_idx, unnest([0, 1]) as slot, unnest([home_team_id, away_team_id]) as team_id
  from (from place4 union all from place3 union all from place2 union all from place1 union all from place0)
  join nodes using (competition, match_id) where home_feeder is null)"""


def _played_round(r: int) -> str:
    """Who comes out of each place of a round, with the chance of every round up to it (``f1`` is the first)."""
    before = [f"f{i}" for i in range(1, r + 1)]
    columns = "".join(f", {f}" for f in before)
    none = "".join(f", null::double as {f}" for f in before)
    either = "".join(
        f", coalesce(case when count({f}) > 0 then 1 - (1 - coalesce(max({f}) filter (slot = 0), 0)) * (1 - coalesce(max({f}) filter (slot = 1), 0)) end, sum(p)) as {f}"
        for f in before)
    arrived = f" union all select competition, place // 2, place % 2, team_id, p{columns} from out{r - 1}" if r else ""
    mine = "".join(f", a.{f}" for f in before)
    return f""", in{r} as (
  select competition, place, slot, team_id, 1::double as p{none} from entrants where round_idx = {r}{arrived}
), met{r} as (
  select a.competition, a.place, a.slot, a.team_id, a.p * sum(b.p * coalesce(w.w, 0.5)) as p{mine}
  from in{r} a join in{r} b on b.competition = a.competition and b.place = a.place and b.slot <> a.slot
  left join win w on w.i = a.team_id and w.j = b.team_id group by a.competition, a.place, a.slot, a.team_id, a.p{mine}
), out{r} as (
  select competition, place, team_id, sum(p) as p{either}, sum(p) as f{r + 1} from met{r} group by competition, place, team_id)"""


def played_nodes(spark, sf):
    return materialise(B.bracket_nodes(facts(spark, sf), BY))


def rated(nodes):
    sides = nodes.select(*BY, F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    return fixed_ratings(sides.distinct(), *BY)


@query("played_nodes", PLAYED + " from nodes")
def q_played_nodes(spark, sf):
    return played_nodes(spark, sf)


@query("played_edges", PLAYED + """ select competition, match_id as parent_match_id, round_idx, cast(slot as integer) as slot,
    child as child_match_id from links join nodes using (competition, match_id)""")
def q_played_edges(spark, sf):
    return B.bracket_edges(played_nodes(spark, sf), BY)


@query("played_advancement", ENTRANTS + WIN + "".join(_played_round(r) for r in range(5)) + """, listed as (
    select competition, home_team_id as team_id from nodes union select competition, away_team_id from nodes)
  select competition, team_id, 1::double as reach_0, """ + ", ".join(f"round(coalesce(f{i}, 0), 6) as reach_{i}" for i in range(1, 6)) + """
  from listed semi join place4 using (competition) left join out4 using (competition, team_id)""")
def q_played_advancement(spark, sf):
    """Every team's chance to reach every round of the trees that the played matches give."""
    nodes = played_nodes(spark, sf)
    return B.advancement(nodes, rated(nodes), BY).select(
        *BY, "team_id", *[F.round(F.get("reach", F.lit(i)), 6).alias(f"reach_{i}") for i in range(6)])


@query("played_win_table", ENTRANTS + WIN + """, stands as (
    select distinct competition, team_id, place >> k as at, case when k = 0 then slot else (place >> (k - 1)) % 2 end as side
    from entrants, range(5) r(k) where place >> k >= 1)
  select distinct a.competition, w.i as team_id, w.j as opponent_id, round(w.w, 6) as win_prob
  from stands a join stands b on b.competition = a.competition and b.at = a.at and b.side <> a.side
  join win w on w.i = a.team_id and w.j = b.team_id""")
def q_played_win_table(spark, sf):
    """Chances of all pairs of teams that can meet in the trees that the played matches give."""
    nodes = played_nodes(spark, sf)
    rows = B.win_table(nodes, rated(nodes), BY)
    return rows.withColumn("win_prob", F.round("win_prob", 6)).distinct()
