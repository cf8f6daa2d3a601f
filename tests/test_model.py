import math

import pytest
from pyspark.sql import functions as F

from scoreloom.functions.poisson import outcome_probs
from scoreloom.plans import bracket as B
from scoreloom.plans import ratings as R

MATCH = ("c int, match_id long, home_team_id long, home_team_name string, away_team_id long, away_team_name string, "
         "home_goals long, away_goals long")


def league(spark):
    games = [(1, 2, 3, 0), (1, 3, 2, 0), (1, 4, 4, 0), (2, 3, 1, 1), (2, 4, 2, 0), (3, 4, 2, 1)]
    rows = [(1, i, h, f"T{h}", a, f"T{a}", x, y) for i, (h, a, x, y) in enumerate(games)]
    rows.append((1, 99, 4, "T4", 1, "T1", None, None))
    return spark.createDataFrame(rows, MATCH)


def test_strength_order_and_centring(spark):
    fit = R.fit_ratings(league(spark), ["c"]).collect()
    by = {r.team_id: r for r in fit}
    order = sorted(by, key=lambda t: -by[t].rating)
    assert order[0] == 1 and order[-1] == 4
    assert abs(sum(r.attack for r in fit)) < 1e-9 and abs(sum(r.defense for r in fit)) < 1e-9
    assert {r.n_matches for r in fit} == {6}
    meta = R.fit_metadata(R.fit_ratings(league(spark), ["c"]), ["c"]).first()
    assert (meta.n_teams, meta.n_matches, meta.ridge) == (4, 6, 0.05)


def goals_of(rows):
    scored, conceded = {}, {}
    for _, _, h, _, a, _, x, y in rows:
        for team, own, other in ((h, x, y), (a, y, x)):
            scored[team] = scored.get(team, 0) + own
            conceded[team] = conceded.get(team, 0) + other
    return {t: (scored[t], conceded[t]) for t in scored}


TWO = [(1, i, 1 + i % 2, "A", 2 - i % 2, "B", i % 3, (i + 1) % 2) for i in range(6)]
MANY = [(1, i, i % 300, "x", (i * 7 + 1 + i // 300) % 300, "x", i % 4, (i // 3) % 3) for i in range(1800) if i % 300 != (i * 7 + 1 + i // 300) % 300]


@pytest.mark.parametrize("solver, rows", [("newton", TWO), ("newton", MANY), ("blocks", TWO)])
def test_fit_balances_goals_at_the_production_tolerance(spark, solver, rows):
    """At the optimum made goals equal scored ones, up to the ridge, for few and for many teams."""
    got = R.fit_balance(spark.createDataFrame(rows, MATCH), ["c"], solver=solver).collect()
    assert {r.team_id: (r.scored, r.conceded) for r in got} == goals_of(rows)


def test_all_matches_as_one_competition(spark):
    a = {r.team_id: r.rating for r in R.fit_ratings(league(spark)).collect()}
    b = {r.team_id: r.rating for r in R.fit_ratings(league(spark), ["c"]).collect()}
    assert a == pytest.approx(b)


def test_one_degenerate_competition_is_named_and_may_be_left_out(spark):
    df = league(spark).unionByName(spark.createDataFrame([(2, 50, 9, "A", 9, "A", 1, 1)], MATCH))
    with pytest.raises(R.FitError, match="'c': 2"):
        R.fit_ratings(df, ["c"])
    assert {r.c for r in R.fit_ratings(df, ["c"], on_failure="skip").collect()} == {1}
    assert [tuple(r) for r in R.fit_status(df, ["c"]).collect()] == [(2, "fewer than two teams")]


def test_a_match_without_ratings_is_loud(spark):
    rated = spark.createDataFrame([(1, 1, 0.1, 0.1, 0.2, 0.3)], "c int, team_id long, attack double, defense double, rating double, home_adv double")
    with pytest.raises(Exception, match="no rating for a team of match"):
        R.with_rates(league(spark).withColumn("stage", F.lit("FINAL")), rated, ["c"], F.lit(True)).collect()


def test_fit_is_a_minimum(spark):
    """No small change of any one parameter improves the penalised likelihood."""
    fit = R.fit_ratings(league(spark), ["c"]).collect()
    rows = [r for r in league(spark).collect() if r.home_goals is not None]
    base = {r.team_id: (r.attack, r.defense) for r in fit}
    home = fit[0].home_adv

    def loss(att, dfn, h, shift_a, shift_d):
        total = 0.05 * (sum((v + shift_a) ** 2 for v in att.values()) + sum((v + shift_d) ** 2 for v in dfn.values()))
        for r in rows:
            for eta, g in ((h + att[r.home_team_id] + shift_a - dfn[r.away_team_id] - shift_d, r.home_goals),
                           (att[r.away_team_id] + shift_a - dfn[r.home_team_id] - shift_d, r.away_goals)):
                total += math.exp(eta) - g * eta
        return total

    att, dfn = ({t: v[i] for t, v in base.items()} for i in (0, 1))
    # the level removed by centring: found by a one-dimensional search (it enters as att = -def)
    shifts = [(x / 1000) for x in range(-1500, 1500)]
    best = min(shifts, key=lambda s: loss(att, dfn, home, s, -s))
    value = loss(att, dfn, home, best, -best)
    assert value == pytest.approx(fit[0].final_nll, abs=1e-3)
    for t in base:
        for d in (-0.05, 0.05):
            assert loss({**att, t: att[t] + d}, dfn, home, best, -best) > value - 1e-6
            assert loss(att, {**dfn, t: dfn[t] + d}, home, best, -best) > value - 1e-6


def test_degenerate_input_is_refused(spark):
    with pytest.raises(R.FitError):
        R.fit_ratings(spark.createDataFrame([], MATCH), ["c"])
    with pytest.raises(R.FitError):
        R.fit_ratings(league(spark), ["c"], max_passes=1)


def test_outcome_probabilities_match_the_grid(spark):
    rates = [(1.5, 1.2), (0.3, 2.4), (2.0, 2.0)]
    df = spark.createDataFrame(rates, "h double, a double")
    for r in df.select("h", "a", outcome_probs("h", "a").alias("p")).collect():
        pmf = lambda lam, k: math.exp(-lam) * lam**k / math.factorial(k)
        grid = [(i, j, pmf(r.h, i) * pmf(r.a, j)) for i in range(11) for j in range(11)]
        mass = sum(p for *_, p in grid)
        assert r.p.p_home == pytest.approx(sum(p for i, j, p in grid if i > j) / mass, abs=1e-12)
        assert r.p.p_draw == pytest.approx(sum(p for i, j, p in grid if i == j) / mass, abs=1e-12)
        assert r.p.p_home + r.p.p_draw + r.p.p_away == pytest.approx(1, abs=1e-9)


def ratings(spark, *values):
    rows = [(1, t, float(a), float(d)) for t, (a, d) in enumerate(values, 1)]
    return spark.createDataFrame(rows, "c int, team_id long, attack double, defense double")


def knockout(spark, *rows):
    return spark.createDataFrame(
        [(1, *r) for r in rows],
        "c int, match_id long, stage string, home_team_id long, away_team_id long, winner string",
    )


SEMIS = ((10, "SEMI_FINALS", 1, 2, "HOME_TEAM"), (11, "SEMI_FINALS", 3, 4, "HOME_TEAM"))
FINAL = (20, "FINAL", 1, 3, "HOME_TEAM")


def test_tree_and_title_odds(spark):
    nodes = B.bracket_nodes(knockout(spark, *SEMIS, FINAL), ["c"])
    by = {r.match_id: r for r in nodes.collect()}
    assert (by[20].home_feeder, by[20].away_feeder) == (10, 11)
    assert by[10].home_feeder is None
    assert {(r.slot, r.child_match_id) for r in B.bracket_edges(nodes, ["c"]).collect()} == {(0, 10), (1, 11)}
    adv = {r.team_id: r for r in B.advancement(nodes, ratings(spark, (.8, .6), (0, 0), (.2, .1), (-.3, -.2)), ["c"]).collect()}
    assert sum(r.title_prob for r in adv.values()) == pytest.approx(1)
    assert max(adv, key=lambda t: adv[t].title_prob) == 1
    for r in adv.values():
        assert r.reach[0] == 1 and r.reach[5] == r.title_prob
        assert all(x >= y - 1e-12 for x, y in zip(r.reach, r.reach[1:]))
    # exact: chance to win the semi-final times the weighted chance against either finalist
    w = {(r.team_id, r.opponent_id): r.win_prob
         for r in B.win_table(nodes, ratings(spark, (.8, .6), (0, 0), (.2, .1), (-.3, -.2)), ["c"]).collect()}
    want = w[1, 2] * (w[3, 4] * w[1, 3] + w[4, 3] * w[1, 4])
    assert adv[1].title_prob == pytest.approx(want, abs=1e-12)
    assert w[1, 3] + w[3, 1] == pytest.approx(1)


def test_missing_winner_makes_the_final_a_leaf(spark):
    rows = (SEMIS[0], (11, "SEMI_FINALS", 3, 4, None), FINAL)
    nodes = B.bracket_nodes(knockout(spark, *rows), ["c"])
    assert nodes.where("match_id = 20 and home_feeder is null and away_feeder is null").count() == 1
    adv = {r.team_id: r.title_prob for r in B.advancement(nodes, ratings(spark, (.1, 0), (0, 0), (0, 0), (0, 0)), ["c"]).collect()}
    assert adv[2] == 0 and adv[4] == 0 and adv[1] + adv[3] == pytest.approx(1)


def test_a_match_that_feeds_both_slots_keeps_the_sum(spark):
    """Team 1 plays and wins both semi-finals after one quarter-final."""
    rows = ((1, "QUARTER_FINALS", 1, 2, "HOME_TEAM"), (2, "QUARTER_FINALS", 3, 4, "AWAY_TEAM"), (3, "QUARTER_FINALS", 5, 6, "HOME_TEAM"),
            (10, "SEMI_FINALS", 1, 4, "HOME_TEAM"), (11, "SEMI_FINALS", 5, 1, "HOME_TEAM"), (20, "FINAL", 1, 5, "AWAY_TEAM"))
    nodes = B.bracket_nodes(knockout(spark, *rows), ["c"])
    rated = ratings(spark, (.5, .1), (0, 0), (.2, 0), (.1, .3), (0, .2), (-.2, 0))
    adv = B.advancement(nodes, rated, ["c"]).collect()
    assert sum(r.title_prob for r in adv) == pytest.approx(1)
    assert all(0 <= x <= 1 for r in adv for x in r.reach)


def test_no_final_gives_nothing(spark):
    nodes = B.bracket_nodes(knockout(spark, *SEMIS), ["c"])
    assert B.advancement(nodes, ratings(spark, (0, 0)), ["c"]).count() == 0


def test_unrated_pair_is_even(spark):
    nodes = B.bracket_nodes(knockout(spark, (20, "FINAL", 8, 9, None)), ["c"])
    assert {r.title_prob for r in B.advancement(nodes, ratings(spark, (0, 0)), ["c"]).collect()} == {0.5}


def test_names_fall_back_to_the_id(spark):
    df = league(spark).withColumn("home_team_name", F.when(F.col("home_team_id") != 1, F.col("home_team_name")))
    names = {r.team_id: r.team_name for r in R.team_names(df.where("away_team_id <> 1"), ["c"]).collect()}
    assert names[1] == "1" and names[2] == "T2"


def test_newton_refuses_crowded_competitions_and_passes_leave_one_state(spark, monkeypatch):
    monkeypatch.setattr(R, "NEWTON_TEAMS", 3)
    with pytest.raises(R.FitError, match="blocks.*'c': 1"):
        R.fit_ratings(league(spark), ["c"])
    saved, dropped = [], []
    keep, drop = R.Workspace.save, R.Workspace.drop
    monkeypatch.setattr(R.Workspace, "save", lambda self, df, name: saved.append(name) or keep(self, df, name))
    monkeypatch.setattr(R.Workspace, "drop", lambda self, *names: dropped.extend(names) or drop(self, *names))
    fit = R.fit_ratings(league(spark), ["c"], solver="blocks").collect()
    assert len(fit) == 4
    assert [n for n in saved if n.startswith("pass") and n not in dropped] == [saved[-1]]
