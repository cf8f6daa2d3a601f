"""Sources and sinks: what is written to the shared folder and read back from it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators.quality import run_checks
from ..operators.reshape import nest_rows
from ..plans import extracts as X
from ..plans.staging import stage_matches
from ..schemas import SCORER_ROW, ddl
from ..shared_store import Workspace
from ..sources import archive as A
from ..sources import json_documents as J
from ..sources.run_log import split_runs
from .contests import raw_matches, teams
from .quality_queries import CHECKS, _checks
from .registry import query, table
from .source_queries import SCORERS, raw_scorers, runs

FEED = "events"


def scorer_rows(spark, sf):
    """Scorer snapshots of all days as one delivery."""
    rows = raw_scorers(spark, sf)
    return rows.where("player.id is not null and team.id is not null").select(*[f.name for f in ddl(SCORER_ROW)], "extraction_date")


DELIVERED = SCORERS + """, delivered as (
  select player_id, team_name, played_matches, goals, nullif(assists, 0) as assists, nullif(penalties, 0) as penalties, extraction_date as day
  from scorers where team_id is not null)"""


@query("archive_round_trip", DELIVERED + """
  select date '2024-03-01' as extraction_date, player_id, team_name, played_matches, goals, assists, penalties from delivered
  union all
  select date '2024-03-02', player_id, team_name, played_matches, goals + 1, assists, penalties from delivered where goals > 0""")
def q_archive_round_trip(spark, sf):
    """One day delivered twice, the first time with wrong goals, and another day once."""
    root = f"{Workspace(spark, 'archive').root}/raw"
    rows = scorer_rows(spark, sf).drop("extraction_date")
    first, second = datetime(2024, 3, 1, 6), datetime(2024, 3, 2, 6)
    A.write_archive(rows.withColumn("goals", F.lit(99).cast("long")), "scorers", root, first, FEED)
    A.write_archive(rows, "scorers", root, first, FEED)
    A.write_archive(rows.where("goals > 0").withColumn("goals", F.col("goals") + 1), "scorers", root, second, FEED)
    return A.read_archive(spark, "scorers", root).select(
        "extraction_date", F.col("player.id").alias("player_id"), F.col("team.name").alias("team_name"),
        F.col("playedMatches").alias("played_matches"), "goals", "assists", "penalties")


@query("archive_catalog", DELIVERED + """
  select extraction_date, count(*) as rows from (
    select date '2024-03-01' as extraction_date from delivered
    union all select date '2024-03-02' from delivered where goals > 0) group by all""")
def q_archive_catalog(spark, sf):
    """Published days and their rows; the delivery that was replaced does not count."""
    root = f"{Workspace(spark, 'archive').root}/raw"
    rows = scorer_rows(spark, sf).drop("extraction_date")
    A.write_archive(rows, "scorers", root, datetime(2024, 3, 1, 6), FEED)
    A.write_archive(rows.where("goals > 0"), "scorers", root, datetime(2024, 3, 2, 5), FEED)
    A.write_archive(rows.where("goals > 0"), "scorers", root, datetime(2024, 3, 2, 6), FEED)
    A.remove_old_loads(spark, "scorers", root)
    return A.archive_catalog(spark, "scorers", root).select("extraction_date", "rows")


@query("drifting_archive", DELIVERED + """
  select day as extraction_date, player_id, goals, case when day(day) % 2 = 0 then assists end as assists,
    case when day(day) % 2 <> 0 then penalties end as penalties from delivered""")
def q_drifting_archive(spark, sf):
    """Days by others in two layouts: even days lack penalties, odd days have assists typed otherwise and empty."""
    root = f"{Workspace(spark, 'foreign').root}/raw"
    rows, base = scorer_rows(spark, sf), f"{root}/scorers"
    even = F.dayofmonth("extraction_date") % 2 == 0
    rows.where(even).drop("penalties").write.partitionBy("extraction_date").parquet(base)
    rows.where(~even).withColumn("assists", F.lit(None).cast("string")).withColumn("goals", F.col("goals").cast("int")).write.mode("append").partitionBy(
        "extraction_date").parquet(base)
    days = [r[0] for r in rows.select("extraction_date").distinct().orderBy("extraction_date").collect()]  # names of folders
    found = A.read_foreign_days(spark, "scorers", root, [f"{base}/extraction_date={d.isoformat()}" for d in days])
    return found.select("extraction_date", F.col("player.id").alias("player_id"), "goals", "assists", "penalties")


@query("json_array_round_trip", "select c_custkey, c_name, c_nationkey, case when c_acctbal < 0 then null else c_acctbal end as balance from customer")
def q_json_array(spark, sf):
    """Customers as one array, dearest first, written and read by many tasks."""
    path = f"{Workspace(spark, 'array').root}/customers"
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.when(~(F.col("c_acctbal") < 0), F.col("c_acctbal")).alias("balance"))
    J.write_json_array(rows, path, [F.col("balance").desc_nulls_last(), F.col("c_custkey").asc()])
    return J.read_json_array(spark, path, "c_custkey BIGINT, c_name STRING, c_nationkey INT, balance DOUBLE")


@query("keyed_document_round_trip", """select o_orderkey::varchar as id, o_orderstatus as status, l_linenumber as number, l_partkey as part, l_quantity as quantity
  from orders join lineitem on l_orderkey = o_orderkey""")
def q_keyed_document(spark, sf):
    """Orders with their nested lines as one file keyed by order, read back in ranges of bytes."""
    root = Workspace(spark, "document").root
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("number"), F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("status"))
    nested = nest_rows(lines, ["l_orderkey"], ["number", "part", "quantity"], ["number", "part", "quantity"], "lines").join(orders, "l_orderkey")
    J.write_json_by_key(nested, f"{root}/pieces", "l_orderkey")
    J.joined(spark, f"{root}/pieces", f"{root}/orders.json")
    read = J.read_json_by_id(
        spark, f"{root}/orders.json", "lines ARRAY<STRUCT<number: INT, part: BIGINT, quantity: DOUBLE>>, status STRING", range_bytes=1 << 19)
    return read.select("id", "value.status", F.explode("value.lines").alias("l")).select("id", "status", "l.*")


@query("metadata", CHECKS + """, runs as (
    select user_id || '/' || cast(ts as date) as run_id, max(case when event_type = 'error' then 1 else 0 end) as failed from events group by 1)
  select '2024-03-01T06:00:00Z' as generated_at,
    (select strftime(max(snapshot_date)::timestamp, '%Y-%m-%dT%H:%M:%SZ') from facts) as last_ingestion, 'orders' as source, 'nations' as competition,
    (select count(*) filter (where status in ('pass', 'success')) from results) as checks_passed, (select count(*) from results) as checks_total,
    (select count(distinct cast(ts as date)) from events) as ingestion_days, (select n || '/' || n from (select count(*) as n from teams)) as reconciliation,
    (select count(*) from runs) as runs_total, (select count(*) from runs where failed = 0) as runs_ok""")
def q_metadata(spark, sf):
    """The freshness banner: loads, runs, checks and the archive's days, which are counted without reading a column."""
    path = f"{Workspace(spark, 'footprint').root}/events"
    table(spark, sf, "events").select("event_id", F.col("ts").cast("date").alias("extraction_date")).write.partitionBy("extraction_date").parquet(path)
    banner = X.metadata(
        stage_matches(raw_matches(spark, sf)), teams(spark, sf), runs(spark, sf), run_checks(_checks(spark, sf)),
        X.archive_footprint(spark.read.parquet(path)), "orders", "nations", datetime(2024, 3, 1, 6))
    return banner.select(*[c for c in banner.columns if c != "ops"], "ops.*")


@query("archive_footprint", "select count(distinct cast(ts as date)) as ingestion_days, count(*) as archived_rows from events")
def q_archive_footprint(spark, sf):
    path = f"{Workspace(spark, 'footprint').root}/events"
    table(spark, sf, "events").select("event_id", F.col("ts").cast("date").alias("extraction_date")).write.partitionBy("extraction_date").parquet(path)
    return X.archive_footprint(spark.read.parquet(path))


@query("run_log_scan", """select case when event_type = 'error' then null else event_type end as stage,
    cast(sum(event_id % 7) as bigint) as rows, count(*) as lines, event_type = 'error' as malformed from events where event_type <> 'view' group by all""")
def q_run_log_scan(spark, sf):
    """A log with planted faults: lines of errors are cut short, those of views are blank."""
    path = f"{Workspace(spark, 'log').root}/runs"
    kind = F.col("event_type")
    record = F.to_json(F.struct(F.col("event_id").cast("string").alias("run_id"), kind.alias("stage"), (F.col("event_id") % 7).alias("rows"), F.lit("ok").alias("status")))
    line = F.when(kind == "view", F.lit("  ")).when(kind == "error", F.concat(F.lit('{"rows": '), (F.col("event_id") % 7).cast("string"), F.lit(', "run'))).otherwise(record)
    table(spark, sf, "events").select(line.alias("value")).write.text(path)
    good, bad = split_runs(spark, path)
    cut = bad.select(F.lit(None).cast("string").alias("stage"), F.regexp_extract("line", r"(\d+)", 1).cast("long").alias("rows"), F.lit(True).alias("malformed"))
    every = good.select("stage", "rows", F.lit(False).alias("malformed")).unionByName(cut)
    return every.groupBy("stage", "malformed").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("lines"))
