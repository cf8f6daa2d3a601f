import json
import logging
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from scoreloom.operators.quality import SchemaContractError, contract_report
from scoreloom.plans.marts import dim_teams, fct_matches, latest_matches
from scoreloom.plans.staging import stage_matches, stage_scorers, stage_standings
from scoreloom.schemas import EVENT_STATISTICS, archive_schema, mart, raw_rows
from scoreloom.sources import (
    archive_days, match_rows, payload_row_count, read_archive, read_csv_table, read_json_by_id, read_payload,
    read_runs, read_statistics_csv, record_run, scorer_rows, standing_rows, write_archive, write_csv_table,
    write_json_array, write_json_record, write_mart, write_view,
)
from scoreloom.sources.archive import RowCountMismatch, archive_catalog, publish, read_foreign_days, remove_old_loads
from scoreloom.sources.run_log import split_runs

AT = datetime(2026, 6, 20, 8, 30, tzinfo=UTC)


def match(i, home=None, away=None, status="TIMED", **score):
    return {
        "id": i, "utcDate": "2026-06-20T18:00:00Z", "status": status, "matchday": 1, "stage": "GROUP_STAGE",
        "group": "GROUP_A", "homeTeam": {"id": 1, "name": "Alphaland", "tla": "ALP"},
        "awayTeam": {"id": 2, "name": "Betaland", "tla": "BET"},
        "score": {"winner": None, "duration": "REGULAR", "fullTime": {"home": home, "away": away}, **score},
        "lastUpdated": "2026-06-20T20:00:00Z",
    }


def entry(pos, team):
    return {"position": pos, "team": {"id": team, "name": f"T{team}", "shortName": "t", "tla": "T", "crest": "c"},
            "playedGames": 1, "won": 1, "draw": 0, "lost": 0, "points": 3, "goalsFor": 1, "goalsAgainst": 0,
            "goalDifference": 1}


@pytest.fixture
def landed(tmp_path):
    docs = {
        "matches": {"matches": [match(1, 2, 1, "FINISHED"), match(2)]},
        "standings": {"competition": {"code": "WC"}, "season": {"id": 9}, "standings": [
            {"group": "Group A", "type": "TOTAL", "table": [entry(1, 1), entry(2, 2)]},
            {"group": "Group B", "type": "TOTAL", "table": [entry(1, 3)]}]},
        "scorers": {"scorers": [{"player": {"id": 7, "name": "P"}, "team": {"id": 1, "name": "A"}, "goals": 3,
                                 "assists": None, "penalties": None, "playedMatches": 2}]},
    }
    for name, doc in docs.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=1))
    return tmp_path


def rows(spark, *items):
    return spark.createDataFrame(list(items), raw_rows("matches"))


def test_payloads_become_rows(spark, landed):
    m = read_payload(spark, "matches", str(landed / "matches.json"))
    assert match_rows(m).count() == 2
    s = read_payload(spark, "standings", str(landed / "standings.json"))
    flat = standing_rows(s).collect()
    assert len(flat) == 3
    assert {(r.standing["group"], r.competition.code, r.season.id) for r in flat} == {
        ("Group A", "WC", 9), ("Group B", "WC", 9)}
    assert s.select(payload_row_count("standings")).first()[0] == 3
    assert m.select(payload_row_count("matches")).first()[0] == 2
    sc = scorer_rows(read_payload(spark, "scorers", str(landed / "scorers.json")))
    staged = stage_scorers(sc.withColumns({"extracted_at": F.lit(AT), "extraction_date": F.lit(AT.date())})).first()
    assert (staged.assists, staged.penalties, staged.goals) == (0, 0, 3)


def test_same_day_replaces_and_other_days_stay(spark, tmp_path):
    root = str(tmp_path / "raw")
    write_archive(rows(spark, match(1), match(2)), "matches", root, AT, "feed")
    write_archive(rows(spark, match(1), match(2)), "matches", root, AT, "feed")
    assert read_archive(spark, "matches", root).count() == 2
    write_archive(rows(spark, match(1, 1, 0, "FINISHED")), "matches", root, AT.replace(day=21), "feed")
    archive = read_archive(spark, "matches", root)
    assert {(r.extraction_date, r.n) for r in archive.groupBy("extraction_date").agg(F.count("*").alias("n")).collect()} == {
        (date(2026, 6, 20), 2), (date(2026, 6, 21), 1)}
    assert archive_days(archive).first()[0] == 2
    current = latest_matches(stage_matches(archive)).collect()
    assert {(r.match_id, r.status) for r in current} == {(1, "FINISHED"), (2, "TIMED")}


def test_empty_input_writes_nothing(spark, tmp_path, caplog):
    with caplog.at_level(logging.WARNING):
        assert write_archive(rows(spark), "matches", str(tmp_path / "none"), AT, "feed") is None
    assert not (tmp_path / "none").exists() and "0 rows" in caplog.text
    assert read_archive(spark, "matches", str(tmp_path / "none")).count() == 0


def test_all_null_day_and_drifting_layouts(spark, tmp_path):
    root = str(tmp_path / "raw")
    write_archive(rows(spark, match(1)), "matches", root, AT, "feed")
    write_archive(rows(spark, match(1, 2, 0, "FINISHED")), "matches", root, AT.replace(day=21), "feed")
    goals = read_archive(spark, "matches", root).select("score.fullTime.home").collect()
    assert {r[0] for r in goals} == {None, 2}
    # days written elsewhere: one lacks a column, one has it typed as something else
    foreign = tmp_path / "foreign" / "scorers"
    base = rows(spark).sparkSession.createDataFrame([(3, 1)], "goals long, playedMatches long")
    base.write.parquet(str(foreign / "extraction_date=2026-06-20"))
    base.select(F.col("goals").cast("int"), F.lit(2).alias("assists")).write.parquet(str(foreign / "extraction_date=2026-06-21"))
    days = [str(foreign / f"extraction_date=2026-06-{d}") for d in (20, 21)]
    got = read_foreign_days(spark, "scorers", str(tmp_path / "foreign"), days)
    assert {f.name for f in archive_schema("scorers")} <= set(got.columns)
    assert {(r.extraction_date, r.goals, r.assists) for r in got.collect()} == {
        (date(2026, 6, 20), 3, None), (date(2026, 6, 21), 3, 2)}


def test_contract_names_every_fault(spark, caplog):
    good = rows(spark, match(1))
    assert contract_report(good, "matches").violations == ()
    assert contract_report(good.withColumn("new", F.lit(1)), "matches").unknown == ("matchday", "new")
    both = good.drop("status").withColumn("id", F.lit("x"))
    text = " ".join(contract_report(both, "matches").violations)
    assert "'status'" in text and "'id'" in text and "string" in text
    null = good.withColumn("utcDate", F.lit(None).cast("string"))
    assert "null in 1 row" in contract_report(null, "matches").violations[0]
    assert not contract_report(good, "players").checked
    with pytest.raises(SchemaContractError, match="status"):
        from scoreloom.operators.quality import require_contract
        require_contract(both, "matches")


def test_bad_contract_stops_before_the_write(spark, tmp_path):
    bad = rows(spark, match(1)).withColumn("stage", F.lit(None).cast("string"))
    with pytest.raises(SchemaContractError):
        write_archive(bad, "matches", str(tmp_path / "raw"), AT, "feed")
    assert not (tmp_path / "raw").exists()


def test_run_log(spark, tmp_path):
    log = str(tmp_path / "runs")
    assert read_runs(spark, log).count() == 0
    for i in range(5):
        record_run(spark, log, run_id=f"r{i}", stage="ingestion", dataset="matches", rows=i, duration_s=1.23456)
    rec = record_run(spark, log, run_id="r9", stage="ingestion", dataset="matches", rows=0, duration_s=0,
                     status="failed", error="x" * 1000)
    assert len(rec["error"]) == 300
    (tmp_path / "runs" / "broken.json").write_text('{"run_id": "z", \n\n not json\n')
    runs = read_runs(spark, log)
    assert runs.count() == 6
    assert {r.duration_s for r in runs.collect()} == {1.23, 0.0}
    assert [r.run_id for r in read_runs(spark, log, 2).collect()] == ["r4", "r9"]
    blocked = tmp_path / "file"
    blocked.write_text("")
    record_run(spark, str(blocked / "sub"), run_id="a", stage="s", dataset="d", rows=1, duration_s=0)


def test_files(spark, tmp_path):
    csv = tmp_path / "stats.csv"
    csv.write_text("team,possession,shots,sot,sot_pct,g_per_sh,ga,sota,saves,save_pct,cs,crdy,crdr\n"
                   "Zed,50.5,10.0,3,30.0,0.1,1,2,1,50,0,1,0\nAbe,49.5,8,2,25,0.2,2,3,1,33.3,1,0,0\n")
    stats = read_statistics_csv(spark, str(csv))
    assert stats.where("team = 'Zed'").first().shots == 10
    write_csv_table(stats, str(tmp_path / "sorted"), "team")
    lines = next((tmp_path / "sorted").glob("part-*")).read_text().splitlines()
    assert lines[0].startswith("team,") and lines[1].startswith("Abe")
    assert read_csv_table(spark, str(tmp_path / "absent.csv"), "a int").count() == 0
    write_json_array(stats.select("team", F.lit(None).cast("int").alias("n")), str(tmp_path / "list"), [F.col("team")])
    docs = json.loads("".join(p.read_text() for p in sorted((tmp_path / "list").glob("part-*"))))
    assert docs == [{"team": "Abe", "n": None}, {"team": "Zed", "n": None}]
    with pytest.raises(ValueError):
        write_json_record(stats, str(tmp_path / "object"))
    assert write_view(stats, "stats_view").count() == 2
    by_id = tmp_path / "by_id.json"
    by_id.write_text(json.dumps({"5": {"statistics": [{"groups": [{"statisticsItems": [{"name": "Total shots", "home": "4", "away": "2"}]}]}]}}))
    row = read_json_by_id(spark, str(by_id), EVENT_STATISTICS).first()
    assert row.id == "5" and row.value.statistics[0].groups[0].statisticsItems[0].home == "4"
    assert read_json_by_id(spark, str(tmp_path / "no.json"), EVENT_STATISTICS).count() == 0


def test_mart_columns_are_enforced(spark, tmp_path):
    staged = stage_matches(rows(spark, match(1, 1, 0, "FINISHED")).withColumns(
        {"extracted_at": F.lit(AT), "extraction_date": F.lit(AT.date())}))
    facts = fct_matches(latest_matches(staged))
    assert [f.name for f in facts.schema] == mart("fct_matches").fieldNames()
    write_mart(facts, "fct_matches", str(tmp_path / "fct"))
    assert spark.read.parquet(str(tmp_path / "fct")).count() == 1
    with pytest.raises(SchemaContractError):
        write_mart(facts.withColumn("match_id", F.col("match_id").cast("int")), "fct_matches", str(tmp_path / "bad"))


def test_shootout_goals_are_taken_out(spark):
    m = match(1, 4, 3, "FINISHED", penalties={"home": 4, "away": 3})
    m["score"].update(winner="HOME_TEAM", duration="PENALTY_SHOOTOUT")
    staged = stage_matches(rows(spark, m).withColumns({"extracted_at": F.lit(AT), "extraction_date": F.lit(AT.date())}))
    fact = fct_matches(staged).first()
    assert (fact.regulation_home_goals, fact.regulation_away_goals, fact.winner) == (0, 0, "HOME_TEAM")
    assert fact.group_code == "A" and str(fact.kickoff_at) == "2026-06-20 18:00:00"


def test_teams_only_in_matches_are_kept(spark, landed):
    stamp = {"extracted_at": F.lit(AT), "extraction_date": F.lit(AT.date())}
    table = standing_rows(read_payload(spark, "standings", str(landed / "standings.json"))).where("team.id <> 2")
    staged = stage_matches(rows(spark, match(1)).withColumns(stamp))
    teams = {r.team_id: r for r in dim_teams(stage_standings(table.withColumns(stamp)), staged).collect()}
    assert set(teams) == {1, 2, 3}
    assert teams[2].team_name == "Betaland" and teams[2].group_code is None and teams[1].group_code == "A"


def test_malformed_timestamp_fails_loudly(spark):
    bad = rows(spark, {**match(1), "utcDate": "tomorrow"}).withColumns({"extracted_at": F.lit(AT), "extraction_date": F.lit(AT.date())})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage_matches(bad).collect()


def test_malformed_log_lines_are_kept_aside(spark, tmp_path):
    good = {"run_id": "r", "stage": "s", "dataset": "d", "rows": 1, "duration_s": 0.5, "status": "ok"}
    lines = [json.dumps(good), "", "   ", '{"run_id": "x", "rows": ', "not json", json.dumps({**good, "rows": "many"})]
    (tmp_path / "runs.jsonl").write_text("\n".join(lines))
    runs, malformed = split_runs(spark, str(tmp_path / "runs.jsonl"))
    assert [r.run_id for r in runs.collect()] == ["r"]
    assert sorted(r.line for r in malformed.collect()) == sorted(lines[3:])


def test_a_failed_delivery_leaves_the_day_as_it_was(spark, tmp_path):
    root = str(tmp_path / "raw")
    write_archive(rows(spark, match(1), match(2)), "matches", root, AT, "feed")
    before = sorted(map(str, read_archive(spark, "matches", root).collect()))
    load = f"extraction_date={AT.date().isoformat()}/load=broken"
    rows(spark, match(3)).write.parquet(f"{root}/matches/{load}")
    with pytest.raises(RowCountMismatch):
        publish(spark, "matches", root, AT.date(), load, 5, AT)
    assert sorted(map(str, read_archive(spark, "matches", root).collect())) == before
    assert [(r.extraction_date, r.rows) for r in archive_catalog(spark, "matches", root).collect()] == [(AT.date(), 2)]
    assert remove_old_loads(spark, "matches", root) == [load]
    assert sorted(map(str, read_archive(spark, "matches", root).collect())) == before


def test_plan_grows_with_layouts_and_not_with_days(spark, tmp_path):
    base = tmp_path / "scorers"
    for d in range(1, 7):
        frame = spark.createDataFrame([(d, 1)], "goals long, playedMatches long")
        (frame if d % 2 else frame.drop("playedMatches")).write.parquet(str(base / f"extraction_date=2026-06-0{d}"))
    days = [str(base / f"extraction_date=2026-06-0{d}") for d in range(1, 7)]
    got = read_foreign_days(spark, "scorers", str(tmp_path), days)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    assert sorted((r.goals, r.playedMatches) for r in got.collect()) == [(d, 1 if d % 2 else None) for d in range(1, 7)]
    assert read_foreign_days(spark, "scorers", str(tmp_path), []).count() == 0
