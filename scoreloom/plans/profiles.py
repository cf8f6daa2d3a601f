"""What the ratings say about matches and teams, and how that compares with other sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.scores import decided_by_side, is_neutral, result_code, score_label
from ..functions.text import number_with_unit, same_name
from ..operators.quality import involves
from ..operators.ranking import top_k
from ..operators.reconcile import paired_by_order, require_matched, require_paired, with_canonical_name
from ..operators.reshape import match_sides, with_group_values
from .extracts import decided_teams, stage_dim
from .ratings import finished_with_score, with_rates


def match_odds(facts: DataFrame, ratings: DataFrame, by: Sequence[str]) -> DataFrame:
    return with_rates(finished_with_score(facts), ratings, by, is_neutral())


def upset_chances(odds: DataFrame) -> DataFrame:
    """Decided matches with the chance their winner had."""
    chance = decided_by_side("winner", F.col("p_home"), F.col("p_away"))
    return odds.where(F.col("winner").isin("HOME_TEAM", "AWAY_TEAM")).withColumn("_p", F.round(chance, 3))


def upsets(odds: DataFrame, by: Sequence[str] = (), k: int = 8) -> DataFrame:
    """Decided matches the winner was least likely to win.

    The cut is made on one number per match; names and scores are formed for the few rows left.
    """
    few = top_k(upset_chances(odds), [F.col("_p").asc_nulls_last(), F.col("match_id").asc()], k)
    return decided_teams(few, by, "_p").select(
        *by, "match_id", "stage", "winner_name", "loser_name", "score", F.col("_p").alias("win_prob"))


def marquee_upset(odds: DataFrame, big_name: str, by: Sequence[str] = ()) -> DataFrame:
    """The least likely win over a named favourite among all matches, else over anyone."""
    rows = decided_teams(upset_chances(odds), by, "_p").select(
        *by, "match_id", "stage", "winner_name", "loser_name", "score", F.col("_p").alias("win_prob"))
    rank = F.struct((~same_name("loser_name", big_name)).alias("other"), F.col("win_prob"), F.col("match_id"))
    return rows.groupBy(*by).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in by]), rank).alias("r")).select(*by, "r.*")


def team_paths(odds: DataFrame, by: Sequence[str], subject: Column | None = None) -> DataFrame:
    """Every finished match from each side's view; ``subject`` keeps one entity.

    The predicate on the entity is applied before the sides are exploded.
    """
    keep = [*by, "match_id", "kickoff_at", "stage", "duration", "winner"]
    if subject is not None:
        odds = odds.where((F.col("home_team_id") == subject) | (F.col("away_team_id") == subject))

    def side(me: str, other: str) -> dict:
        label = f"{me.upper()}_TEAM"
        return {
            "team_id": f"{me}_team_id", "opponent_id": f"{other}_team_id",
            "opponent": f"{other}_team_name",
            "score": score_label(
                f"regulation_{me}_goals", f"regulation_{other}_goals", "duration",
                f"penalty_{me}_goals", f"penalty_{other}_goals",
            ),
            "result": result_code("winner", label),
            "win_prob": F.round(f"p_{me}", 3),
            "model_xg_for": F.round(f"xg_{me}", 2), "model_xg_against": F.round(f"xg_{other}", 2),
        }

    legs = match_sides(odds, home=side("home", "away"), away=side("away", "home"), keep=keep)
    if subject is not None:
        legs = legs.where(F.col("team_id") == subject)
    return legs.drop("duration", "winner")


def path_order() -> list[Column]:
    return [F.col("kickoff_at").asc_nulls_last(), F.col("match_id").asc()]


def closest_match(path: DataFrame, by: Sequence[str]) -> DataFrame:
    """The match an entity was least sure to win."""
    row = F.struct("match_id", "stage", "opponent", "score", "result", "win_prob")
    return path.groupBy(*by, "team_id").agg(
        F.min_by(row, F.struct("win_prob", "kickoff_at", "match_id")).alias("r")
    ).select(*by, "team_id", "r.*")


def entity_case(
    strength: DataFrame, odds: DataFrame, by: Sequence[str], subject: str | None = None
) -> DataFrame:
    """Headline numbers of an entity: ratings, results and title odds with their rank."""
    fields = [
        "team_name", "crest", "rank_overall", "rank_attack", "rank_defense", "goals_for", "xgf",
        "goals_against", "xga", "points", "xpoints", "performance",
    ]
    sizes = strength.groupBy(*by).agg(F.count(F.lit(1)).alias("n_teams"))
    order = W.partitionBy(*by).orderBy(F.col("title_prob").desc_nulls_last(), F.col("team_id").asc())
    placed = odds.withColumn("title_rank", F.row_number().over(order).cast("long")).select(
        *by, "team_id", "title_prob", "title_rank"
    )
    chosen = strength if subject is None else strength.where(same_name("team_name", subject))
    chosen = with_group_values(chosen, sizes, by)
    return chosen.join(placed, [*by, "team_id"], "left").select(
        *by, "team_id", *fields, "n_teams",
        F.round(F.coalesce("title_prob", F.lit(0.0)), 4).alias("title_prob"), "title_rank",
    )


def runner_up_ratio(odds: DataFrame, by: Sequence[str]) -> DataFrame:
    """How many times likelier the first favourite is than the second."""
    order = W.partitionBy(*by).orderBy(F.col("title_prob").desc_nulls_last(), F.col("team_id").asc())
    two = odds.withColumn("_n", F.row_number().over(order)).where("_n <= 2")
    first = F.max(F.when(F.col("_n") == 1, F.col("title_prob")))
    second = F.max(F.when(F.col("_n") == 2, F.col("title_prob")))
    return two.groupBy(*by).agg(
        F.round(first / F.nullif(second, F.lit(0.0))).cast("long").alias("ratio")
    )


def rating_vs_finish(
    facts: DataFrame, ratings: DataFrame, teams: DataFrame, by: Sequence[str], subject: str = ""
) -> DataFrame:
    """Rating beside the deepest stage a team appeared in (0 when in none)."""
    depth = stage_dim(facts.sparkSession).select("stage", "depth")
    legs = match_sides(
        facts, home={"team_id": "home_team_id"}, away={"team_id": "away_team_id"},
        keep=[*by, "stage"],
    )
    # few distinct (team, stage) pairs reach the join
    seen = legs.distinct().join(depth, "stage", "left")
    deepest = seen.groupBy(*by, "team_id").agg(F.max(F.coalesce("depth", F.lit(0))).alias("_deep"))
    names = teams.select(*by, "team_id", "team_name", "team_tla")
    return ratings.join(deepest, [*by, "team_id"], "left").join(names, [*by, "team_id"], "left").select(
        *by, "team_id", F.coalesce("team_name", F.col("team_id").cast("string")).alias("team_name"),
        "team_tla", F.round("rating", 3).alias("rating"),
        F.coalesce("_deep", F.lit(0)).alias("finish"),
        same_name("team_name", subject).alias("highlight"),
    )


def over_under(strength: DataFrame, by: Sequence[str], min_played: int = 3, k: int = 10) -> DataFrame:
    """The ``k`` largest gaps between points and expected points, best luck first.

    ``performance_rank`` places a row among all eligible teams of its competition.
    """
    gap = F.col("points") - F.col("xpoints")
    eligible = strength.where(F.col("played") >= min_played).withColumn("gap", F.round(gap, 2))
    w = W.partitionBy(*by)
    placed = eligible.withColumns({
        "performance_rank": F.row_number().over(w.orderBy(F.col("gap").desc(), F.col("team_id").asc())).cast("long"),
        "_size": F.row_number().over(w.orderBy(F.abs("gap").desc(), F.col("team_id").asc())),
    })
    return placed.where(F.col("_size") <= k).select(
        *by, "team_id", "team_name", "played", "points", "xpoints", "gap", "performance_rank"
    )


def scatter_labels(strength: DataFrame, by: Sequence[str], top: int = 5) -> DataFrame:
    """Which teams to name in a chart: the best overall, the best attack, the worst defence."""
    worst = strength.groupBy(*by).agg(F.max("rank_defense").alias("_worst"))
    both = with_group_values(strength, worst, by)
    show = (
        (F.col("rank_overall") <= top) | (F.col("rank_attack") == 1)
        | (F.col("rank_defense") == F.col("_worst"))
    )
    return both.select(*by, "team_id", "team_name", "attack", "defense", show.alias("show"))


# --- against other sources ----------------------------------------------------------------


def team_reality(
    strength: DataFrame, statistics: DataFrame, by: Sequence[str] = (), aliases=V.TEAM_ALIASES
) -> DataFrame:
    """Ratings beside measured statistics; names must match in both directions."""
    named = with_canonical_name(statistics, "team", aliases, "team_name")
    require_matched(named, strength, "team_name", "statistics name")
    require_matched(strength, named, "team_name", "rated team")
    return reality_rows(strength, named, by)


def reality_rows(strength: DataFrame, named: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    stats = ["possession", "shots", "sot", "sot_pct", "sota", "ga", "save_pct", "cs"]
    return strength.join(
        named.select(*by, "team_name", *stats, F.col("g_per_sh").alias("conversion")),
        [*by, "team_name"],
    ).select(
        *by, "team_id", "team_name", "team_tla", "crest", "rank_overall", "rank_attack",
        "rank_defense", "attack", "defense", "rating", *stats, "conversion",
    )


def correlation(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.round(F.corr(x, y), 4).alias("r"), F.round(F.avg(y), 4).alias(f"avg_{y}"),
        F.count(F.lit(1)).alias("n"),
    )


def holds_maximum(df: DataFrame, value: str, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Per entity, whether nobody of its competition has a larger value."""
    top = df.groupBy(*by).agg(F.max(value).alias("_max"))
    both = with_group_values(df, top, by)
    return both.select(*by, key, (F.col(value) >= F.col("_max")).alias("has_top"))


def season_events(events: DataFrame, tournament_id: int, season_id: int, subject_id: int) -> DataFrame:
    """Events of one tournament season; each must involve the subject."""
    chosen = events.where(
        (F.col("tournament.uniqueTournament.id") == tournament_id)
        & (F.col("season.id") == season_id)
    )
    strangers = involves(chosen, subject_id, "homeTeam.id", "awayTeam.id").take(1)
    if strangers:
        raise ValueError(f"event {strangers[0]['id']} does not involve team {subject_id}")
    return chosen


REAL_FIELDS = {
    # output: (statistic name, own side?)  -- fixed values: names in the source
    "possession": ("Ball possession", True),
    "xg_for": ("Expected goals", True),
    "xg_against": ("Expected goals", False),
    "shots": ("Total shots", True),
    "sot": ("Shots on target", True),
    "big_chances": ("Big chances", True),
}


def event_side_statistics(events: DataFrame, statistics: DataFrame, subject: str) -> DataFrame:
    """One row per event with the subject's own (or the rival's) value of each statistic."""
    at_home = F.col("homeTeam.name") == subject
    items = F.flatten(F.transform(F.get("value.statistics", F.lit(0))["groups"], lambda g: g["statisticsItems"]))

    def value(name: str, own: bool) -> Column:
        item = F.get(F.filter("_items", lambda x: x["name"] == name), F.lit(0))
        home = at_home if own else ~at_home
        return number_with_unit(F.when(home, item["home"]).otherwise(item["away"]))

    keyed = statistics.select(F.col("id").alias("_id"), items.alias("_items"))
    joined = events.join(keyed, F.col("id").cast("string") == F.col("_id"), "left")
    return joined.select(
        "id", "startTimestamp", *[value(*spec).alias(out) for out, spec in REAL_FIELDS.items()]
    )


def real_vs_model(path: DataFrame, events: DataFrame, statistics: DataFrame, subject: str) -> DataFrame:
    """Measured statistics beside the model for each match of a path, paired by chronology."""
    measured = event_side_statistics(events, statistics, subject).withColumn("_s", F.lit(1))
    steps = path.withColumn("_s", F.lit(1))
    paired = paired_by_order(
        steps, measured, ["_s"], path_order(),
        [F.coalesce("startTimestamp", F.lit(0)).asc(), F.col("id").asc()], ("p", "e"),
    )
    rows = require_paired(paired, ("p", "e"))
    return rows.select(
        F.col("step").cast("long").alias("step"),
        *[F.col(f"p_{c}").alias(c) for c in ("stage", "opponent", "score")],
        *[F.col(f"e_{c}").alias(c) for c in REAL_FIELDS],
        F.col("p_model_xg_for").alias("model_xg_for"),
        F.col("p_model_xg_against").alias("model_xg_against"),
    )


def shots(events: DataFrame, shot_maps: DataFrame, subject: str) -> DataFrame:
    """One row per shot: coordinates, value rounded to three digits, goal and own-side flags."""
    at_home = (F.col("homeTeam.name") == subject).alias("_at_home")
    keyed = shot_maps.select(F.col("id").alias("_id"), F.posexplode("value.shotmap").alias("shot_no", "s"))
    joined = events.select("id", at_home).join(keyed, F.col("id").cast("string") == F.col("_id"))
    xg = F.round(F.coalesce(number_with_unit("s.xg"), F.lit(0.0)), 3)
    return joined.select(
        F.col("id").alias("event_id"), "shot_no",
        F.col("s.playerCoordinates.x").alias("x"), F.col("s.playerCoordinates.y").alias("y"),
        xg.alias("xg"), F.coalesce(F.col("s.shotType") == "goal", F.lit(False)).alias("goal"),
        F.coalesce(F.col("s.isHome") == F.col("_at_home"), F.lit(False)).alias("own"),
        F.col("s.player.name").alias("player"),
    )


def shot_summary(shot_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return shot_rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("shots"), F.round(F.sum("xg"), 3).alias("xg"),
        F.count_if("goal").alias("goals"),
    )
