"""Expressions over one match row: goals, winner, orientation, points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def without_shootout(goals, kicks, duration="duration") -> Column:
    """Goals of the match itself: shootout kicks are taken out of the reported total."""
    counted = F.when(_c(duration) == V.SHOOTOUT, F.coalesce(_c(kicks), F.lit(0))).otherwise(0)
    return _c(goals) - counted


def winner_id(winner="winner", home="home_team_id", away="away_team_id") -> Column:
    """Id of the winning side, NULL for draws and undecided matches."""
    w = _c(winner)
    return F.when(w == "HOME_TEAM", _c(home)).when(w == "AWAY_TEAM", _c(away))


def decided_by_side(winner, home_value, away_value) -> Column:
    """The home value when home won, the away value when away won, else NULL."""
    return F.when(_c(winner) == "HOME_TEAM", home_value).when(
        _c(winner) == "AWAY_TEAM", away_value
    )


def points_from_goals(scored, conceded) -> Column:
    return (
        F.when(_c(scored) > _c(conceded), V.POINTS_WIN)
        .when(_c(scored) == _c(conceded), V.POINTS_DRAW)
        .otherwise(0)
    )


def points_from_winner(winner, side: str | Column) -> Column:
    """Points by declared winner, so a shootout counts as won and lost, not as drawn."""
    return (
        F.when(_c(winner) == side, V.POINTS_WIN)
        .when(_c(winner) == "DRAW", V.POINTS_DRAW)
        .otherwise(0)
    )


def result_code(winner, side: str | Column) -> Column:
    """V (won), N (drawn) or D (anything else) seen from ``side``."""
    return F.when(_c(winner) == side, "V").when(_c(winner) == "DRAW", "N").otherwise("D")


def score_label(mine, theirs, duration=None, my_kicks=None, their_kicks=None) -> Column:
    """``2–1``; a shootout appends how it ended, ``0–0 (4–3 t.a.b.)``."""
    base = F.concat(_c(mine).cast("string"), F.lit(V.EN_DASH), _c(theirs).cast("string"))
    if duration is None:
        return base
    kicks = F.concat(
        F.lit(" ("), _c(my_kicks).cast("string"), F.lit(V.EN_DASH),
        _c(their_kicks).cast("string"), F.lit(f" {V.SHOOTOUT_MARK})"),
    )
    shown = (_c(duration) == V.SHOOTOUT) & _c(my_kicks).isNotNull()
    return F.concat(base, F.when(shown, kicks).otherwise(F.lit("")))


def is_neutral(stage="stage") -> Column:
    """Only the group stage gives the listed home side a venue advantage."""
    return _c(stage) != V.GROUP_STAGE
