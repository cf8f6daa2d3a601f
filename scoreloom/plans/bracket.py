"""Knockout tree from results, and the exact distribution of who advances.

A bracket of the five title rounds has at most 31 matches and 62 places, so everything kept
per match below (at most 2^round entrants a slot) is bounded by construction, however many
competitions are processed together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..config import materialise
from ..functions.poisson import outcome_probs
from ..functions.scores import winner_id
from ..operators.ranking import top_k_per_key


def _round_index(stage: str = "stage") -> Column:
    order = F.array(*[F.lit(s) for s in V.TITLE_PATH])
    return (F.array_position(order, F.col(stage)) - 1).cast("int")


def bracket_nodes(knockout: DataFrame, by: Sequence[str]) -> DataFrame:
    """Matches of the title rounds with the two earlier matches that feed them.

    A side's feeder is the match of the previous round that this side won. A match without
    both feeders is a leaf and stands with its own two teams.
    """
    by = list(by)
    # a few matches per competition, read three times below
    rounds = materialise(knockout.where(F.col("stage").isin(*V.TITLE_PATH)).select(
        *by, "match_id", _round_index().alias("round_idx"), "home_team_id", "away_team_id",
        winner_id().alias("_won"),
    ))
    feeders = rounds.where(F.col("_won").isNotNull()).groupBy(
        *by, (F.col("round_idx") + 1).alias("round_idx"), F.col("_won").alias("_team")
    ).agg(F.max("match_id").alias("_match"))

    def fed(df: DataFrame, side: str) -> DataFrame:
        mine = feeders.select(
            *by, "round_idx", F.col("_team").alias(f"{side}_team_id"),
            F.col("_match").alias(f"_{side}_feeder"),
        )
        return df.join(mine, [*by, "round_idx", f"{side}_team_id"], "left")

    both = F.col("_home_feeder").isNotNull() & F.col("_away_feeder").isNotNull()
    return fed(fed(rounds, "home"), "away").select(
        *by, "match_id", "round_idx", "home_team_id", "away_team_id",
        F.when(both, F.col("_home_feeder")).alias("home_feeder"),
        F.when(both, F.col("_away_feeder")).alias("away_feeder"),
    )


def bracket_edges(nodes: DataFrame, by: Sequence[str], *keep: str) -> DataFrame:
    """The tree as (parent, slot, child) rows."""
    slots = F.array(
        F.struct(F.lit(0).alias("slot"), F.col("home_feeder").alias("child_match_id")),
        F.struct(F.lit(1).alias("slot"), F.col("away_feeder").alias("child_match_id")),
    )
    return (
        nodes.select(*by, *keep, F.col("match_id").alias("parent_match_id"), "round_idx", F.inline(slots))
        .where(F.col("child_match_id").isNotNull())
    )


def title_tree(nodes: DataFrame, by: Sequence[str]) -> DataFrame:
    """Matches below the final, each at its ``place``: 1 is the final, 2p and 2p + 1 feed place p.

    A match that feeds two others stands in the tree twice, at two places, so nothing multiplies.
    """
    by = list(by)
    last = len(V.TITLE_PATH) - 1
    finals = nodes.where(F.col("round_idx") == last)
    level = top_k_per_key(finals, by, [F.col("match_id").asc()], 1, "_n").drop("_n") if by else (
        finals.orderBy("match_id").limit(1)
    )
    level = level.withColumn("place", F.lit(1))
    tree = level
    for _ in range(last):
        links = bracket_edges(level.withColumnRenamed("place", "_place"), by, "_place").select(
            *by, F.col("child_match_id").alias("match_id"), (F.col("_place") * 2 + F.col("slot")).alias("place"))
        level = nodes.join(links, [*by, "match_id"]).select(*level.columns)
        tree = tree.unionByName(level)
    return materialise(tree)


def _entrants(tree: DataFrame, ratings: DataFrame, by: list[str]) -> DataFrame:
    """Teams of the leaves, each certain to be in its slot, with their ratings."""
    places = "inline(array(struct(0 as slot, home_team_id as team_id), struct(1 as slot, away_team_id as team_id)))"
    leaves = tree.where("home_feeder is null").selectExpr(*by, "place", "round_idx", places)
    params = ratings.select(*by, "team_id", "attack", "defense")
    return leaves.join(params, [*by, "team_id"], "left")


def _meetings(here: DataFrame, by: list[str]) -> DataFrame:
    """Every pair (a, b) that can meet at a place, and ``beats``: P(a beats b).

    The venue is neutral and a draw counts half for either; a pair with an unrated team is even.
    """
    sides = here.groupBy(*by, "place").agg(
        F.expr("collect_list(who) filter (where slot = 0)").alias("first"),
        F.expr("collect_list(who) filter (where slot = 1)").alias("second"),
    )
    pairs = sides.selectExpr(*by, "place", "explode(first) as a", "second").selectExpr(
        *by, "place", "a", "explode(second) as b"
    )
    rates = pairs.selectExpr(
        "*", "exp(a.attack - b.defense) as _mine", "exp(b.attack - a.defense) as _theirs"
    )
    return rates.select("*", outcome_probs("_mine", "_theirs").alias("_p")).selectExpr(
        *by, "place", "a", "b",
        f"coalesce(_p.p_home + _p.p_draw / 2, {V.UNKNOWN_PAIR_PROBABILITY}D) as beats",
    )


def advancement(nodes: DataFrame, ratings: DataFrame, by: Sequence[str]) -> DataFrame:
    """Probability of every bracket team to reach each round; ``reach[5]`` is the title.

    Round by round a team keeps one row per place with its chance to come out of it: over all
    it can meet there, the chance of the meeting times the chance to win it. A team that stands at
    several places of a round reaches it if it comes out of any of them. The result is exact;
    nothing is sampled. Competitions without a final give no rows.
    """
    by = list(by)
    tree = title_tree(nodes, by)
    leaves = _entrants(tree, ratings, by).selectExpr(
        *by, "place", "slot", "round_idx",
        "struct(team_id, attack, defense, 1D as p, cast(array() as array<double>) as reach) as who",
    )
    last = len(V.TITLE_PATH)
    # a team that enters late is as sure of the earlier rounds as of its first match
    reached = "if(size(reach) = 0, array_repeat(p, {n}), array_append(reach, p))"
    either = "zip_with(reach0, reach1, (x, y) -> 1 - (1 - coalesce(x, 0D)) * (1 - coalesce(y, 0D)))"
    state = None
    for r in range(last):
        here = leaves.where(f"round_idx = {r}").select(*by, "place", "slot", "who")
        if state is not None:
            here = here.unionByName(state.selectExpr(*by, "place div 2 as place", "cast(place % 2 as int) as slot", "who")
                                    .withColumn("place", F.col("place").cast("int")))
        won = _meetings(here, by).selectExpr(*by, "place", """inline(array(
            struct(0 as slot, a as who, a.p * b.p * beats as part), struct(1 as slot, b as who, a.p * b.p * (1 - beats) as part)))""")
        state = won.groupBy(*by, "place", "who.team_id").agg(
            F.sum("part").alias("p"), F.max("who.attack").alias("attack"), F.max("who.defense").alias("defense"),
            F.expr("max(if(slot = 0, who.reach, null)) as reach0"), F.expr("max(if(slot = 1, who.reach, null)) as reach1"),
        ).selectExpr(
            *by, "place", "team_id", "p", "attack", "defense",
            f"case when reach0 is null then reach1 when reach1 is null then reach0 else {either} end as reach",
        ).selectExpr(*by, "place", f"struct(team_id, attack, defense, p, {reached.format(n=r + 1)} as reach) as who")
    has_final = tree.where("place = 1").select(*by).distinct()
    listed = nodes.selectExpr(*by, "explode(array(home_team_id, away_team_id)) as team_id")
    listed = listed.where("team_id is not null").distinct()
    listed = listed.join(has_final, by, "left_semi") if by else listed.crossJoin(has_final.limit(1))
    known = state.selectExpr(*by, "who.team_id as team_id", "who.reach as _reach")
    return listed.join(known, [*by, "team_id"], "left").selectExpr(
        *by, "team_id", f"concat(array(1D), coalesce(_reach, array_repeat(0D, {last}))) as reach"
    ).withColumn("title_prob", F.expr(f"reach[{last}]"))


def win_table(nodes: DataFrame, ratings: DataFrame, by: Sequence[str]) -> DataFrame:
    """P(team beats opponent) at a neutral venue for all pairs that can meet in the bracket.

    The places below a match are at most 2^(round+1), so a team meets a bounded number of others.
    """
    by = list(by)
    tree = title_tree(nodes, by)
    here = _entrants(tree, ratings, by).selectExpr(*by, "place", "slot", "struct(team_id, attack, defense) as who")
    up = f"inline(transform(sequence(0, {len(V.TITLE_PATH) - 1}), k -> struct(shiftright(place, k) as at, if(k = 0, slot, cast(shiftright(place, k - 1) % 2 as int)) as of)))"
    places = here.selectExpr(*by, up, "who").where("at >= 1").selectExpr(*by, "at as place", "of as slot", "who").distinct()
    return _meetings(places, by).where("a.team_id <> b.team_id").selectExpr(
        *by, "inline(array(struct(a.team_id as team_id, b.team_id as opponent_id, beats as win_prob), "
        "struct(b.team_id as team_id, a.team_id as opponent_id, 1 - beats as win_prob)))"
    ).distinct()


def title_odds(advance: DataFrame, teams: DataFrame, by: Sequence[str], k: int = 12) -> DataFrame:
    """The ``k`` likeliest champions of every competition."""
    order = [F.col("title_prob").desc_nulls_last(), F.col("team_id").asc()]
    best = top_k_per_key(advance, by, order, k, "title_rank") if by else (
        advance.orderBy(*order).limit(k)
    )
    badge = teams.select(*by, "team_id", "team_name", "team_tla", F.col("team_crest_url").alias("crest"))
    return best.join(badge, [*by, "team_id"], "left").withColumns({
        "team_name": F.coalesce("team_name", F.col("team_id").cast("string")),
        "title_prob": F.round("title_prob", 4),
        "reach": F.transform("reach", lambda x: F.round(x, 3)),
    })


def title_progression(odds: DataFrame, by: Sequence[str]) -> DataFrame:
    """Level by level, how likely the listed teams get there: from ``title_odds``, one row per team and level."""
    names = F.array(*[F.lit(x) for x in V.REACH_LEVELS])
    levels = odds.select(*by, "team_id", "team_name", "title_rank", F.posexplode("reach").alias("level_order", "probability"))
    return levels.select(*by, "team_id", "team_name", "title_rank", "level_order", F.get(names, F.col("level_order")).alias("level"), "probability")
