"""Outcome probabilities of two independent Poisson scores, as column expressions.

The (n+1)×(n+1) score grid is never built. Going up one goal at a time, a fold carries both
pmf values (p_k = p_{k-1}·λ/k) and both running sums; home wins by k goals against fewer add
``p_home[k] · Σ_{j<k} p_away[j]``, and likewise for away. The three totals are divided by
the mass inside the grid because the tail beyond n goals is cut off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V


def outcome_probs(home_rate: str, away_rate: str, max_goals: int = V.MAX_GOALS) -> Column:
    """Struct (p_home, p_draw, p_away) from two rate columns; the three sum to one."""
    home, away = f"(s.home * {home_rate} / k)", f"(s.away * {away_rate} / k)"
    mass = "(s.win + s.draw + s.loss)"
    return F.expr(f"""
        aggregate(
          sequence(1, {max_goals}),
          named_struct('home', exp(-{home_rate}), 'away', exp(-{away_rate}),
                       'home_below', exp(-{home_rate}), 'away_below', exp(-{away_rate}),
                       'win', 0D, 'draw', exp(-{home_rate} - {away_rate}), 'loss', 0D),
          (s, k) -> named_struct('home', {home}, 'away', {away},
                       'home_below', s.home_below + {home}, 'away_below', s.away_below + {away},
                       'win', s.win + {home} * s.away_below, 'draw', s.draw + {home} * {away},
                       'loss', s.loss + {away} * s.home_below),
          s -> named_struct('p_home', s.win / {mass}, 'p_draw', s.draw / {mass},
                            'p_away', s.loss / {mass}))
    """)


def goal_rates(
    home_attack: Column, home_defense: Column, away_attack: Column, away_defense: Column,
    home_advantage: Column, neutral: Column,
) -> tuple[Column, Column]:
    """Expected goals (home, away) on the log-linear scale of the rating model."""
    lift = F.when(neutral, F.lit(0.0)).otherwise(home_advantage)
    return F.exp(lift + home_attack - away_defense), F.exp(away_attack - home_defense)
