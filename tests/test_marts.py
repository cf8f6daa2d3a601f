from datetime import date

import pytest
from pyspark.sql import functions as F
from test_standings import matches

from scoreloom.config import Edition
from scoreloom.operators.quality import mart_checks, run_checks
from scoreloom.operators.reconcile import ReconciliationError
from scoreloom.plans.marts import fct_group_standings, mart_edition_comparison
from scoreloom.plans.profiles import team_reality
from scoreloom.schemas import EDITION_SEED, TEAM_STATS, mart
from scoreloom.sources.files import pick_columns


def full_facts(spark):
    base = matches(spark, (1, 2, 1, 0), (3, 1, 2, 1), (2, 3, 2, 1))
    have = set(base.columns)
    extra = {f.name: F.lit(None).cast(f.dataType) for f in mart("fct_matches") if f.name not in have}
    extra |= {
        "regulation_home_goals": F.col("full_time_home_goals"), "regulation_away_goals": F.col("full_time_away_goals"),
        "kickoff_at": F.lit("2026-06-12").cast("timestamp_ntz"), "duration": F.lit("REGULAR"),
        "winner": F.when(F.col("full_time_home_goals") > F.col("full_time_away_goals"), "HOME_TEAM").otherwise("AWAY_TEAM"),
    }
    return base.withColumns(extra).select(mart("fct_matches").fieldNames())


def test_standing_assertions_over_the_marts(spark):
    facts = full_facts(spark)
    teams = spark.createDataFrame([(i, n, None, None, None, "X") for i, n in ((1, "Alphaland"), (2, "Betaland"))], mart("dim_teams"))
    scorers = spark.createDataFrame([(1, 5, "P", None, 1, "Alphaland", None, None, 3, 2, 0, 0)], mart("mart_top_scorers"))
    marts = {"dim_teams": teams, "fct_matches": facts, "fct_group_standings": fct_group_standings(facts), "mart_top_scorers": scorers}
    checks = mart_checks(marts, {"fct_matches": 3, "dim_teams": 3}, ["X"])
    failed = {r.check: r.failures for r in run_checks(checks).where("status <> 'pass'").collect()}
    # team 3 is unknown to the dimension, which also is one row short
    assert failed == {"dim_teams_rows": 1, "fct_matches_home_team": 1, "fct_matches_away_team": 1, "standings_team": 1}


def test_running_edition_beside_history(spark):
    history = spark.createDataFrame([(2018, "A", "Gammaland", 32, 64, 169, 2.64), (2022, "B", "Alphaland", 32, 64, 172, 2.69)], EDITION_SEED)
    facts = full_facts(spark).withColumn("stage", F.when(F.col("match_id") == 3, "FINAL").otherwise(F.col("stage")))
    edition = Edition(2026, "C", 3, 3, 1, date(2026, 6, 11), date(2026, 7, 19))
    rows = {r.year: r for r in mart_edition_comparison(history, facts, edition).collect()}
    now = rows[2026]
    assert (now.winner, now.teams, now.matches, now.goals, now.goals_per_match) == ("Betaland", 3, 3, 7, 2.33)
    assert now.is_current and [rows[y].goals_per_match_rank for y in (2022, 2018, 2026)] == [1, 2, 3]


def test_reality_needs_names_on_both_sides(spark):
    strength = spark.createDataFrame(
        [(1, "Turkey", "TUR", "c", 1, 1, 1, .1, .2, .3)],
        "team_id long, team_name string, team_tla string, crest string, rank_overall long, rank_attack long, "
        "rank_defense long, attack double, defense double, rating double",
    )
    stats = spark.createDataFrame([("Türkiye", 50.0, 9, 4, 44.4, 0.1, 1, 3, 2, 66.7, 1, 0, 0)], TEAM_STATS)
    row = team_reality(strength, stats).first()
    assert (row.team_name, row.shots, row.conversion, row.save_pct) == ("Turkey", 9, 0.1, 66.7)
    more = strength.union(strength.withColumn("team_name", F.lit("Atlantis")))
    with pytest.raises(ReconciliationError, match="rated team: .*Atlantis"):
        team_reality(more, stats)


def test_columns_of_a_wide_table(spark):
    wide = spark.createDataFrame([("x", 1, 2)], "team string, `Standard.Sh` int, `Standard.SoT` int")
    assert pick_columns(wide, {"team": "team", "Standard.Sh": "shots"}).columns == ["team", "shots"]
