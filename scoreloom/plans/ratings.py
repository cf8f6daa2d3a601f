"""Attack / defence ratings from results, and what the ratings say about every match.

Model: home goals ~ Poisson(exp(home_adv + attack_home - defense_away)), away goals ~
Poisson(exp(attack_away - defense_home)), with a ridge on attack and defence only.

Matches are reduced to one row per (competition, home, away) once; nothing later reads them
again. The caller names the solver, never the size of the data: "newton" solves every competition in
one task, suits leagues and tournaments and refuses competitions of more than ``NEWTON_TEAMS`` teams;
"blocks" takes passes of joins and aggregates in which no competition is ever held in one place. A pass is
one job: it writes its state to the shared folder, and the worst gradient is observed on the way.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V
from ..config import materialise
from ..functions.poisson import goal_rates, outcome_probs
from ..functions.scores import is_neutral, points_from_winner
from ..operators.ranking import ranked
from ..operators.reshape import match_sides
from ..shared_store import Workspace, ship_package


class FitError(Exception):
    """The data cannot support a fit, or the fit did not converge."""


TOLERANCE = 1e-7  # gradient entry over the goals behind it (or one)
NEWTON_TEAMS = 2_000  # a dense system of twice as many unknowns, 128 MB, in one task
NEWTON_STEPS = 12  # of an equation in one unknown, which is convex and increasing


def pair_results(matches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Matches and goals per ordered pair; rows without both teams and goals do not count."""
    used = matches.dropna(subset=["home_team_id", "away_team_id", "home_goals", "away_goals"])
    return used.groupBy(*by, F.col("home_team_id").alias("home"), F.col("away_team_id").alias("away")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("home_goals").alias("home_goals"),
        F.sum("away_goals").alias("away_goals"),
    )


def team_names(matches: DataFrame, by: Sequence[str]) -> DataFrame:
    """First-seen name per team in match order, or the id as text."""
    seen = match_sides(
        matches,
        home={"team_id": "home_team_id", "name": "home_team_name"},
        away={"team_id": "away_team_id", "name": "away_team_name"},
        keep=[*by, "match_id"],
    ).where(F.col("team_id").isNotNull())
    return seen.groupBy(*by, "team_id").agg(
        F.coalesce(F.min_by("name", "match_id"), F.col("team_id").cast("string")).alias("team_name")
    )


# --- solver "newton": a competition is one small system in one task -----------------------------


def _newton(pair_rows: pd.DataFrame, home, away, teams: int, ridge: float, tol: float, max_iter: int):
    """Damped Newton on (attack, defense, home advantage); returns (theta, loss, gradient norm)."""
    scorer, conceder = np.concatenate([home, away]), np.concatenate([away, home])
    at_home = np.repeat([1.0, 0.0], len(home))
    n = np.tile(pair_rows["n"].to_numpy(float), 2)
    goals = pair_rows[["home_goals", "away_goals"]].to_numpy(float).T.ravel()
    penalty = np.append(np.full(2 * teams, 2 * ridge), 0.0)

    def eta(theta):
        return at_home * theta[-1] + theta[scorer] - theta[teams + conceder]

    def loss(theta):
        e = eta(theta)
        return float(n @ np.exp(e) - goals @ e + 0.5 * penalty @ theta**2)

    def per_team(values):
        return np.concatenate([
            np.bincount(scorer, values, teams), -np.bincount(conceder, values, teams),
            [at_home @ values],
        ])

    theta = np.zeros(2 * teams + 1)
    value = loss(theta)
    behind = np.maximum(1.0, np.abs(per_team(goals)))
    for _ in range(max_iter):
        mean = n * np.exp(eta(theta))
        grad = per_team(mean - goals) + penalty * theta
        norm = float((np.abs(grad) / behind).max())
        if norm <= tol:
            break
        hessian = np.diag(penalty + np.concatenate([
            np.bincount(scorer, mean, teams), np.bincount(conceder, mean, teams), [0.0],
        ]))
        np.add.at(hessian, (scorer, teams + conceder), -mean)
        np.add.at(hessian, (teams + conceder, scorer), -mean)
        hessian[-1] += per_team(at_home * mean)
        hessian[:-1, -1] = hessian[-1, :-1]
        step = np.linalg.solve(hessian, grad)
        scale = 1.0
        while (trial := loss(theta - scale * step)) > value and scale > 1e-8:
            scale /= 2
        theta, value = theta - scale * step, trial
    return theta, value, norm


def _fit_in_tasks(pairs: DataFrame, by: Sequence[str], ridge, tol, max_iter) -> DataFrame:
    keys = [pairs.schema[c] for c in by]
    out = T.StructType([
        *keys, *T.StructType.fromDDL(
            "team_id BIGINT, attack DOUBLE, defense DOUBLE, home_adv DOUBLE, final_nll DOUBLE, "
            "gradient DOUBLE, n_matches BIGINT"
        ).fields,
    ])
    by = list(by)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["home", "away"])
        ids, index = np.unique(np.concatenate([pdf["home"], pdf["away"]]), return_inverse=True)
        k, rows = len(ids), len(pdf)
        theta, loss, norm = _newton(pdf, index[:rows], index[rows:], k, ridge, tol, max_iter)
        frame = pd.DataFrame({
            "team_id": ids, "attack": theta[:k], "defense": theta[k : 2 * k],
            "home_adv": theta[-1], "final_nll": loss, "gradient": norm,
            "n_matches": int(pdf["n"].sum()),
        })
        for c in by:
            frame[c] = pdf[c].iloc[0]
        return frame[out.fieldNames()]

    ship_package(pairs.sparkSession)
    return pairs.groupBy(*by).applyInPandas(fit, out)


# --- solver "blocks": passes of joins and aggregates, for competitions of any size ----------------


def _root(start: str, weight: str, pull: str, target: str, spread: str) -> str:
    """SQL for x with ``weight * exp(x) + pull * (spread * x) = target``, by Newton from ``start``."""
    value = f"{weight} * exp(x) + {pull} * {spread} * x - ({target})"
    slope = f"{weight} * exp(x) + {pull} * {spread}"
    step = f"x - greatest(-2D, least(2D, ({value}) / ({slope})))"
    return f"aggregate(sequence(1, {NEWTON_STEPS}), {start}, (x, _i) -> {step})"


def _sides(pairs: DataFrame, by: list[str]) -> DataFrame:
    """(scorer, conceder, at_home, n, goals): each pair seen from both scoring sides."""
    return match_sides(
        pairs.withColumns({"yes": F.lit(1), "no": F.lit(0)}),
        home={"scorer": "home", "conceder": "away", "at_home": "yes", "n": "n", "goals": "home_goals"},
        away={"scorer": "away", "conceder": "home", "at_home": "no", "n": "n", "goals": "away_goals"},
        keep=by,
    )


def _pass(sides: DataFrame, state: DataFrame, by: list[str], ridge: float) -> DataFrame:
    """New attack, then defence, then home advantage and common level, each exact given the others.

    ``gradient`` is the worst relative entry met before the updates; once it is within the
    tolerance the updates no longer move anything.
    """
    keys, twice = [*by, "team_id"], 2 * ridge
    rival = state.selectExpr(*by, "team_id as conceder", "dfn as _dfn", "home_adv as _home")
    for_scorer = sides.join(rival, [*by, "conceder"]).groupBy(*by, F.col("scorer").alias("team_id")).agg(
        F.expr("sum(n * exp(if(at_home = 1, _home, 0D) - _dfn)) as _e"))
    attack = state.join(for_scorer, keys, "left").selectExpr(
        *by, "team_id", "scored", "conceded", "dfn", "home_adv", "home_total", "away_total",
        f"abs(coalesce(_e, 0D) * exp(att) + {twice} * att - scored) / greatest(scored, 1) as g_att",
        _root("att", "coalesce(_e, 0D)", str(twice), "scored", "1") + " as att",
    )
    own = attack.selectExpr(*by, "team_id as scorer", "att as _att", "home_adv as _home")
    for_conceder = sides.join(own, [*by, "scorer"]).groupBy(*by, F.col("conceder").alias("team_id")).agg(
        F.expr("sum(if(at_home = 1, n * exp(_home + _att), 0D)) as _fh"),
        F.expr("sum(if(at_home = 0, n * exp(_att), 0D)) as _fa"))
    # with y = -defence the equation has the form of the attack's
    both = attack.join(for_conceder, keys, "left").selectExpr(
        "*", "coalesce(_fh, 0D) + coalesce(_fa, 0D) as _f").selectExpr(
        *by, "team_id", "scored", "conceded", "att", "home_adv", "home_total", "away_total", "g_att", "_fh", "_fa",
        f"abs(_f * exp(-dfn) - {twice} * dfn - conceded) / greatest(conceded, 1) as g_dfn",
        "-(" + _root("-dfn", "_f", str(twice), "conceded", "1") + ") as dfn",
    )
    level = both.groupBy(*by).agg(
        F.expr("sum(coalesce(_fh, 0D) * exp(-dfn)) as _sh"), F.expr("sum(coalesce(_fa, 0D) * exp(-dfn)) as _sa"),
        F.expr("max(home_adv) as _h0"), F.expr("max(home_total) as _th"), F.expr("max(away_total) as _ta"),
        F.expr("sum(att) as _sum_att"), F.expr("sum(dfn) as _sum_dfn"), F.expr("cast(count(1) as double) as _teams"),
        F.expr("max(greatest(g_att, g_dfn)) as _worst"),
    ).selectExpr(
        *by, "_sh", "_th", "_h0", "_teams", "_sum_att", "_sum_dfn",
        "greatest(_worst, abs(_sh - _th) / greatest(_th, 1)) as gradient",
        # attack up by x with the home advantage free to follow: away goals and ridge fix x
        _root("0D", "_sa", str(twice), f"_ta - {twice} * _sum_att", "_teams") + " as _x",
    ).selectExpr(
        *by, "gradient", "_x",
        "_h0 + ln(greatest(_th, 1e-6D) / _sh) - _x as home_new",
        # a common shift of both blocks changes no rate, so the ridge alone fixes it
        "(_sum_att + _teams * _x + _sum_dfn) / (2 * _teams) as _c",
    )
    return both.join(level, by).selectExpr(
        *keys, "att + _x - _c as u_att", "dfn - _c as u_dfn", "home_new as u_home", "gradient")


def _mixed(moved: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """Where the next pass starts: the new values, shifted by what the last two moves promise.

    Competitions of few or hardly connected teams leave slow directions to block updates. With r the
    move of a pass and u its outcome, u - t (u - u before) is taken with the t that makes the moves,
    mixed alike, shortest. The optimum stays where no pass moves anything.
    """
    keys = [*by, "team_id"]
    rows = moved.selectExpr(*keys, "u_att", "u_dfn", "u_home", "gradient").join(state.drop("gradient"), keys).selectExpr(
        "*", "u_att - att as r_att", "u_dfn - dfn as r_dfn", "u_home - home_adv as r_home")
    dot = lambda x, y: f"sum({x.format('att')} * {y.format('att')} + {x.format('dfn')} * {y.format('dfn')}) + max({x.format('home')} * {y.format('home')})"
    change = "(r_{0} - r_{0}_0)"
    weight = rows.groupBy(*by).agg(
        F.expr(f"({dot(change, 'r_{0}')}) / nullif({dot(change, change)}, 0D) as _t")).selectExpr(*by, "coalesce(_t, 0D) as _t")
    return rows.join(weight, by).selectExpr(
        *keys, "scored", "conceded", "home_total", "away_total", "gradient",
        *[f"u_{x} - if(_t = 0, 0D, _t * (u_{x} - u_{x}_0)) as {v}" for x, v in (("att", "att"), ("dfn", "dfn"), ("home", "home_adv"))],
        *[f"{k}_{x} as {k}_{x}_0" for k in "ur" for x in ("att", "dfn", "home")])


def _objective(sides: DataFrame, state: DataFrame, by: list[str], ridge: float) -> DataFrame:
    own = state.selectExpr(*by, "team_id as scorer", "att", "home_adv")
    rival = state.selectExpr(*by, "team_id as conceder", "dfn")
    loss = sides.join(own, [*by, "scorer"]).join(rival, [*by, "conceder"]).selectExpr(
        *by, "n", "goals", "if(at_home = 1, home_adv, 0D) + att - dfn as eta").groupBy(*by).agg(
        F.expr("sum(n * exp(eta) - goals * eta) as _loss"))
    penalty = state.groupBy(*by).agg(F.expr(f"{ridge} * sum(att * att + dfn * dfn) as _penalty"))
    return loss.join(penalty, by).selectExpr(*by, "_loss + _penalty as final_nll")


def fit_ratings(
    matches: DataFrame, by: Sequence[str] = (), ridge: float = V.RIDGE, tol: float = TOLERANCE,
    max_passes: int = 200, centred: bool = True, on_failure: str = "raise", solver: str = "newton",
) -> DataFrame:
    """Ratings per (competition, team): attack, defense, rating, home_adv, final_nll, n_matches.

    ``by`` may be empty: all matches are one competition then. Attack and defence are centred
    after the fit unless ``centred`` is False; the level removed by that is not put back into
    the expected goals, which keeps results equal to the published ones. A competition with
    fewer than two teams, or one that did not converge, makes the call raise ``FitError`` with
    its name, or is left out with ``on_failure="skip"``; ``fit_status`` lists them.
    """
    fitted, failed = _fit(matches, list(by), ridge, tol, max_passes, solver)
    if on_failure == "raise":
        worst = failed.limit(5).collect()
        if worst:
            raise FitError("no fit for " + ", ".join(str(r.asDict()) for r in worst))
        if not fitted.take(1):
            raise FitError("a fit needs at least two teams and one match")
    by = list(by)
    one = [] if by else ["_all"]
    if centred:
        means = fitted.groupBy(*by, *one).agg(F.avg("attack").alias("_a"), F.avg("defense").alias("_d"))
        fitted = fitted.join(means, [*by, *one]).withColumns(
            {"attack": F.col("attack") - F.col("_a"), "defense": F.col("defense") - F.col("_d")})
    return fitted.withColumn("rating", F.col("attack") + F.col("defense")).select(
        *by, "team_id", "attack", "defense", "rating", "home_adv", "final_nll", "n_matches")


def fit_status(
    matches: DataFrame, by: Sequence[str] = (), ridge: float = V.RIDGE, tol: float = TOLERANCE, max_passes: int = 200, solver: str = "newton",
) -> DataFrame:
    """Competitions without a fit and why."""
    return _fit(matches, list(by), ridge, tol, max_passes, solver)[1]


def _fit(
    matches: DataFrame, by: list[str], ridge: float, tol: float, max_passes: int, solver: str,
) -> tuple[DataFrame, DataFrame]:
    """(fitted teams with uncentred values, competitions that have no fit)."""
    named = list(by)
    if not by:
        matches, by = matches.withColumn("_all", F.lit(1)), ["_all"]
    pairs = materialise(pair_results(matches, by))
    sides = _sides(pairs, by)
    ends = sides.selectExpr(*by, "inline(array(struct(scorer as team_id), struct(conceder as team_id)))").distinct()
    counted = ends.groupBy(*by).agg(F.count(F.lit(1)).alias("_teams"))
    few = counted.where("_teams < 2").select(*by, F.lit("fewer than two teams").alias("reason"))
    if solver == "newton":
        crowded = counted.where(F.col("_teams") > NEWTON_TEAMS).limit(5).collect()
        if crowded:
            raise FitError(f"more than {NEWTON_TEAMS} teams, use the solver \"blocks\": " + ", ".join(str(r.asDict()) for r in crowded))
    usable = pairs.join(counted.where("_teams >= 2").select(*by), by, "left_semi")
    solve = {"newton": _fit_in_tasks, "blocks": _fit_in_blocks}[solver]
    fitted = materialise(solve(usable, by, ridge, tol, max_passes))
    met = F.col("gradient") <= tol
    stuck = fitted.where(~met).select(*by, F.lit("did not converge").alias("reason")).distinct()
    return fitted.where(met).drop("gradient"), few.unionByName(stuck).select(*named, "reason")


def _fit_in_blocks(pairs: DataFrame, by: list[str], ridge: float, tol: float, max_passes: int) -> DataFrame:
    sides = _sides(pairs, by)
    per_team = sides.selectExpr(*by, """inline(array(
        struct(scorer as team_id, goals as scored, 0L as conceded, goals * at_home as home_scored, goals * (1 - at_home) as away_scored),
        struct(conceder as team_id, 0L as scored, goals as conceded, 0L as home_scored, 0L as away_scored)))""").groupBy(*by, "team_id").agg(
        *[F.sum(c).alias(c) for c in ("scored", "conceded", "home_scored", "away_scored")])
    totals = per_team.groupBy(*by).agg(F.sum("home_scored").alias("home_total"), F.sum("away_scored").alias("away_total"))
    work = Workspace(pairs.sparkSession, "fit")
    sides = work.save(sides, "sides")
    state = work.save(per_team.join(totals, by).selectExpr(
        *by, "team_id", "scored", "conceded", "0D as att", "0D as dfn", "0D as home_adv", "home_total", "away_total", "1D as gradient",
        *[f"cast(null as double) as {k}_{x}_0" for k in "ur" for x in ("att", "dfn", "home")]), "pass0")
    for k in range(1, max_passes + 1):
        seen = Observation()
        moved = _mixed(_pass(sides, state, by, ridge), state, by)
        state = work.save(moved.observe(seen, F.max("gradient").alias("worst")), f"pass{k}")
        work.drop(f"pass{k - 1}")  # the new state is whole
        worst = seen.get["worst"]
        if worst is None or worst <= tol:
            break
    sizes = pairs.groupBy(*by).agg(F.sum("n").alias("n_matches"))
    return state.join(sizes, by).join(_objective(sides, state, by, ridge), by).selectExpr(
        *by, "team_id", "att as attack", "dfn as defense", "home_adv", "final_nll", "gradient", "n_matches")


def fit_balance(matches: DataFrame, by: Sequence[str], ridge: float = V.RIDGE, solver: str = "newton") -> DataFrame:
    """Goals made and let in by every team as the fit has them, with the ridge's share.

    At the optimum they equal the goals scored and conceded.
    """
    by = list(by)
    rated = fit_ratings(matches, by, ridge, centred=False, solver=solver)
    sides = _sides(pair_results(matches, by), by)
    own = rated.selectExpr(*by, "team_id as scorer", "attack", "home_adv")
    rival = rated.selectExpr(*by, "team_id as conceder", "defense")
    mean = sides.join(own, [*by, "scorer"]).join(rival, [*by, "conceder"]).selectExpr(
        *by, "scorer", "conceder", "n * exp(if(at_home = 1, home_adv, 0D) + attack - defense) as mean")
    per_team = mean.selectExpr(*by, "inline(array(struct(scorer as team_id, mean as made, 0D as let_in), struct(conceder as team_id, 0D as made, mean as let_in)))")
    sums = per_team.groupBy(*by, "team_id").agg(F.sum("made").alias("made"), F.sum("let_in").alias("let_in"))
    return sums.join(rated, [*by, "team_id"]).selectExpr(
        *by, "team_id", f"round(made + {2 * ridge} * attack, 2) as scored", f"round(let_in - {2 * ridge} * defense, 2) as conceded")


def fit_metadata(ratings: DataFrame, by: Sequence[str], ridge: float = V.RIDGE) -> DataFrame:
    return ratings.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_teams"), F.first("n_matches").alias("n_matches"),
        F.round(F.first("home_adv"), 3).alias("home_adv"), F.lit(ridge).alias("ridge"),
        F.round(F.first("final_nll"), 2).alias("final_nll"),
    )


# --- using ratings --------------------------------------------------------------------------


def with_rates(matches: DataFrame, ratings: DataFrame, by: Sequence[str], neutral: Column | None = None) -> DataFrame:
    """Matches with expected goals, outcome probabilities and both ratings."""

    def side(name: str, extra: tuple = ()) -> DataFrame:
        return ratings.select(
            *by, F.col("team_id").alias(f"{name}_team_id"), F.col("attack").alias(f"_{name}_att"),
            F.col("defense").alias(f"_{name}_def"), F.col("rating").alias(f"{name}_rating"), *extra,
        )

    keyed = matches.join(side("home", ("home_adv",)), [*by, "home_team_id"], "left").join(
        side("away"), [*by, "away_team_id"], "left"
    )
    # a match without ratings is a fault of the input; dropping it would shift every total
    unrated = F.col("home_rating").isNull() | F.col("away_rating").isNull()
    keyed = keyed.withColumn("home_rating", F.when(
        unrated, F.raise_error(F.concat(F.lit("no rating for a team of match "), F.col("match_id").cast("string"))).cast("double")
    ).otherwise(F.col("home_rating")))
    home, away = goal_rates(
        F.col("_home_att"), F.col("_home_def"), F.col("_away_att"), F.col("_away_def"),
        F.col("home_adv"), is_neutral() if neutral is None else neutral,
    )
    return (
        keyed.withColumns({"xg_home": home, "xg_away": away})
        .withColumn("_p", outcome_probs("xg_home", "xg_away"))
        .select(*matches.columns, "home_rating", "away_rating", "xg_home", "xg_away", "_p.*")
    )


def model_legs(rated: DataFrame, by: Sequence[str]) -> DataFrame:
    """Side rows of finished matches with actual and expected goals and points."""

    def side(me: str, other: str) -> dict:
        return {
            "team_id": f"{me}_team_id", "goals_for": f"regulation_{me}_goals",
            "goals_against": f"regulation_{other}_goals", "xgf": f"xg_{me}", "xga": f"xg_{other}",
            "points": points_from_winner("winner", f"{me.upper()}_TEAM"),
            "xpoints": F.col(f"p_{me}") * V.POINTS_WIN + F.col("p_draw") * V.POINTS_DRAW,
            "opponent_rating": f"{other}_rating",
        }

    return match_sides(rated, home=side("home", "away"), away=side("away", "home"), keep=list(by))


def finished_with_score(facts: DataFrame) -> DataFrame:
    return facts.where((F.col("status") == V.FINISHED) & F.col("regulation_home_goals").isNotNull())


def with_rating_ranks(ratings: DataFrame, by: Sequence[str], bounded_fields: bool = True) -> DataFrame:
    """Rank overall, in attack and in defence; equal values rank by id."""
    for name, column in (("overall", "rating"), ("attack", "attack"), ("defense", "defense")):
        order = [F.col(column).desc_nulls_last(), F.col("team_id").asc()]
        if bounded_fields:
            place = F.row_number().over(W.partitionBy(*by).orderBy(*order)).cast("long")
            ratings = ratings.withColumn(f"rank_{name}", place)
        else:
            ratings = ranked(ratings, order, f"rank_{name}", by)
    return ratings


def team_strength(
    facts: DataFrame, ratings: DataFrame, teams: DataFrame, by: Sequence[str],
    bounded_fields: bool = True,
) -> DataFrame:
    """Ratings, ranks and actual against expected results of every rated team.

    The ranks are windows over one row per team of a competition; pass ``bounded_fields=False``
    where a competition can have very many teams, and they come from distributed sorts.
    """
    by = list(by)
    legs = model_legs(with_rates(finished_with_score(facts), ratings, by), by)
    sums = legs.groupBy(*by, "team_id").agg(
        F.count(F.lit(1)).alias("played"),
        *[F.sum(c).alias(c) for c in ("goals_for", "goals_against", "xgf", "xga", "points", "xpoints")],
        F.sum("opponent_rating").alias("_opp"),
    )

    badge = teams.select(*by, "team_id", "team_name", "team_tla", F.col("team_crest_url").alias("crest"))
    rows = (
        with_rating_ranks(ratings, by, bounded_fields)
        .join(sums, [*by, "team_id"], "left").join(badge, [*by, "team_id"], "left")
    )

    def total(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0))

    played = total("played")
    return rows.select(
        *by, "team_id", F.coalesce("team_name", F.col("team_id").cast("string")).alias("team_name"),
        "team_tla", "crest",
        *[F.round(c, 3).alias(c) for c in ("attack", "defense", "rating")],
        *[F.col(f"rank_{n}").cast("long").alias(f"rank_{n}") for n in ("overall", "attack", "defense")],
        played.alias("played"), total("goals_for").alias("goals_for"),
        total("goals_against").alias("goals_against"),
        F.round(total("xgf"), 2).alias("xgf"), F.round(total("xga"), 2).alias("xga"),
        total("points").alias("points"), F.round(total("xpoints"), 2).alias("xpoints"),
        F.round(total("points") - total("xpoints"), 2).alias("performance"),
        F.when(played > 0, F.round(F.col("_opp") / played, 3)).otherwise(0.0).alias("sos"),
    )
