import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from scoreloom import fixed_values as V
from scoreloom.operators import quality as Q
from scoreloom.operators import reconcile as C
from scoreloom.plans import extracts as X
from scoreloom.plans import profiles as P
from scoreloom.schemas import EVENT, EVENT_SHOTS, EVENT_STATISTICS
from scoreloom.sources import read_json_by_id, read_json_rows


def test_differences_show_missing_and_unequal(spark):
    a = spark.createDataFrame([(1, 5, None), (2, 6, 1), (3, 7, 1)], "k int, v int, w int")
    b = spark.createDataFrame([(1, 5, 3), (2, 9, 1), (4, 1, 1)], "k int, v int, w int")
    got = {r.k: (r.computed_v, r.official_v) for r in C.differences(a, b, ["k"], ["v", "w"]).collect()}
    assert got == {2: (6, 9), 3: (7, None), 4: (None, 1)}


def test_unknown_names_are_listed(spark):
    stats = spark.createDataFrame([("Türkiye",), ("Atlantis",)], "team string")
    named = C.with_canonical_name(stats, "team", V.TEAM_ALIASES, "team_name")
    known = spark.createDataFrame([("Turkey",)], "team_name string")
    with pytest.raises(C.ReconciliationError, match="Atlantis"):
        C.require_matched(named, known, "team_name", "statistics")
    C.require_matched(named.where("team <> 'Atlantis'"), known, "team_name", "statistics")


def test_alias_faults(spark):
    aliases = spark.createDataFrame([("a", "X"), ("b", "X"), ("c", "Z")], "source_name string, canonical_name string")
    names = spark.createDataFrame([("a",), ("b",)], "source_name string")
    assert {(r.source_name, r.fault) for r in Q.alias_faults(aliases, names).collect()} == {
        ("c", "unknown source name"), ("a", "shared canonical name"), ("b", "shared canonical name")}
    assert len(set(V.TEAM_ALIASES.values())) == len(V.TEAM_ALIASES)


def test_merge_refuses_a_repeated_key(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "team string, p int")
    b = spark.createDataFrame([("x", 3), ("y", 4)], "team string, q int")
    assert C.merge_one_to_one([a, b], "team").count() == 2
    with pytest.raises(C.AlignmentError, match="more than once"):
        C.merge_one_to_one([a, b.union(b)], "team")


@pytest.fixture
def feeds(spark, tmp_path):
    def event(i, ts, home, away):
        return {"id": i, "startTimestamp": ts, "homeTeam": {"id": 1 if home == "Us" else 2, "name": home},
                "awayTeam": {"id": 1 if away == "Us" else 2, "name": away},
                "tournament": {"uniqueTournament": {"id": 16}}, "season": {"id": 5}}

    def stats(home_xg, away_xg, poss):
        items = [{"name": "Expected goals", "home": home_xg, "away": away_xg},
                 {"name": "Ball possession", "home": poss, "away": "x"}]
        return {"statistics": [{"groups": [{"statisticsItems": items[:1]}, {"statisticsItems": items[1:]}]}]}

    shots = {"11": {"shotmap": [
        {"playerCoordinates": {"x": 1.5, "y": 2.0}, "xg": 0.12345, "shotType": "goal", "isHome": False, "player": {"name": "A"}},
        {"xg": None, "shotType": "save", "isHome": True}]}}
    docs = {"events": [event(11, 200, "Them", "Us"), event(10, 100, "Us", "Them")],
            "statistics": {"10": stats("1.5", "0.4", "67%")}, "shots": shots}
    for name, doc in docs.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
    return (read_json_rows(spark, str(tmp_path / "events.json"), EVENT),
            read_json_by_id(spark, str(tmp_path / "statistics.json"), EVENT_STATISTICS),
            read_json_by_id(spark, str(tmp_path / "shots.json"), EVENT_SHOTS))


def path(spark, n):
    rows = [(i, datetime(2026, 6, i), "GROUP_STAGE", "Them", "1–0", 1.1, 0.9) for i in range(1, n + 1)]
    return spark.createDataFrame(rows, "match_id long, kickoff_at timestamp_ntz, stage string, opponent string, "
                                       "score string, model_xg_for double, model_xg_against double")


def test_sources_pair_by_chronology(spark, feeds):
    events, stats, shots = feeds
    rows = P.real_vs_model(path(spark, 2), events, stats, "Us").orderBy("step").collect()
    assert (rows[0].possession, rows[0].xg_for, rows[0].xg_against, rows[0].shots) == (67.0, 1.5, 0.4, None)
    assert rows[1].xg_for is None
    with pytest.raises(C.AlignmentError):
        P.real_vs_model(path(spark, 3), events, stats, "Us")
    out = {r.shot_no: r for r in P.shots(events, shots, "Us").collect()}
    assert (out[0].xg, out[0].goal, out[0].own, out[0].player) == (0.123, True, True, "A")
    assert (out[1].xg, out[1].x, out[1].own) == (0.0, None, False)
    total = P.shot_summary(P.shots(events, shots, "Us")).first()
    assert (total.shots, total.goals, total.xg) == (2, 1, 0.123)


def test_events_must_involve_the_subject(spark, feeds):
    events, *_ = feeds
    assert P.season_events(events, 16, 5, 1).count() == 2
    assert P.season_events(events, 16, 6, 1).count() == 0
    with pytest.raises(ValueError, match="does not involve"):
        P.season_events(events, 16, 5, 77)


def test_checks_run_together(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (None, "z", 50)], "k int, s string, v int")
    checks = [
        Q.Check("unique", Q.unique(df, "k")), Q.Check("null", Q.not_null(df, "v"), "warn"),
        Q.Check("values", Q.accepted_values(df, "s", ["a", "b"])), Q.Check("range", Q.accepted_range(df, "v", 0, 99)),
        Q.Check("rows", Q.row_count_equals(df, 3)), Q.Check("pair", Q.unique(df, ["k", "s"])),
    ]
    results = Q.run_checks(checks)
    assert {(r.check, r.failures, r.status) for r in results.collect()} == {
        ("unique", 1, "error"), ("null", 1, "warn"), ("values", 1, "error"), ("range", 0, "pass"),
        ("rows", 0, "pass"), ("pair", 0, "pass")}
    assert tuple(Q.passed_and_total(results).first()) == (3, 6)


def test_freshness_levels(spark):
    df = spark.createDataFrame([("a", datetime(2026, 7, 1)), ("b", datetime(2026, 7, 2)), ("c", None)], "k string, extracted_at timestamp")
    got = {r.k: r.status for r in Q.freshness(df, datetime(2026, 7, 3, 3), by=["k"]).collect()}
    assert got == {"a": "error", "b": "warn", "c": "error"}


def test_metadata_and_output_contract(spark):
    df = spark.createDataFrame([(1, datetime(2026, 7, 1))], "id int, extracted_at timestamp")
    runs = spark.createDataFrame([("r1", "ok"), ("r1", "failed"), ("r2", "ok")], "run_id string, status string")
    checks = spark.createDataFrame([("a", 0, "pass")], "check string, failures long, status string")
    days = spark.createDataFrame([(4,)], "ingestion_days long")
    row = X.metadata(df, df, runs, checks, days, "feed", "Cup", datetime(2026, 7, 2)).first()
    assert (row.reconciliation, row.ops.runs_total, row.ops.runs_ok, row.ingestion_days) == ("1/1", 2, 1, 4)
    assert row.last_ingestion == "2026-07-01T00:00:00Z"
    assert Q.output_contract(df, ["id", "x"], "d") == ["d: missing column 'x'"]
    assert Q.output_contract(df.where("false"), ["id"], "d") == ["d: empty"]
    assert df.select(F.lit(1)).count() == 1


def test_checks_of_a_table_share_a_pass_and_equal_those_apart(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (None, "c", 500), (None, "c", 7), (2, None, 8)], "k INT, s STRING, v INT")
    other = spark.createDataFrame([(1,), (1,), (1,)], "k INT")
    together = [
        Q.TableCheck("unique", df, key="k"), Q.TableCheck("null", df, F.col("v").isNull(), severity="warn"),
        Q.TableCheck("range", df, Q.outside("v", 0, 99)), Q.TableCheck("rows", df, rows=5), Q.TableCheck("wrong_rows", df, rows=4),
        Q.TableCheck("values", df, values=("s", ("a", "x"))), Q.TableCheck("second_key", df, key="s"), Q.TableCheck("other_rows", other, rows=3),
        Q.TableCheck("other_key", other, key="k"), Q.TableCheck("empty", df.limit(0), F.col("v") > 0), Q.TableCheck("empty_key", df.limit(0), key="k"),
    ]
    apart = [
        Q.Check("unique", Q.unique(df, "k")), Q.Check("null", Q.not_null(df, "v"), "warn"), Q.Check("range", Q.accepted_range(df, "v", 0, 99)),
        Q.Check("rows", Q.row_count_equals(df, 5)), Q.Check("wrong_rows", Q.row_count_equals(df, 4)), Q.Check("values", Q.accepted_values(df, "s", ("a", "x"))),
        Q.Check("second_key", Q.unique(df, "s")), Q.Check("other_rows", Q.row_count_equals(other, 3)), Q.Check("other_key", Q.unique(other, "k")),
        Q.Check("empty", df.limit(0)), Q.Check("empty_key", Q.unique(df.limit(0), "k")),
    ]
    assert sorted(map(tuple, Q.run_checks(together).collect())) == sorted(map(tuple, Q.run_checks(apart).collect()))


def test_checks_of_one_key_read_the_table_once(spark, tmp_path):
    spark.range(10).selectExpr("id as k", "id % 3 as v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = Q.run_checks([Q.TableCheck("key", df, key="k"), *[Q.TableCheck(f"v{i}", df, F.col("v") == i) for i in range(5)]])
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
