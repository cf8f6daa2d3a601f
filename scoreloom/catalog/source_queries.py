"""Nested snapshots, scorers, run log and parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import display, text
from ..operators import latest_per_key, top_k, top_k_per_key, union_by_name
from ..operators.quality import contract_violations
from ..operators.ranking import as_of
from ..plans import extracts as X
from ..plans import profiles as P
from ..plans.marts import mart_top_scorers
from ..plans.staging import stage_scorers
from ..sources.archive import archive_days
from ..sources.payloads import match_rows, payload_row_count, standing_rows
from .contests import raw_matches
from .registry import query, table

LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]


@query("latest_snapshot", """select l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity
  from (select *, row_number() over (partition by l_orderkey
    order by l_shipdate desc, l_linenumber desc, l_partkey desc, l_suppkey desc) as rn from lineitem) where rn = 1""")
def q_latest(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", *LINE_ORDER, "l_quantity")
    return latest_per_key(lines, ["l_orderkey"], LINE_ORDER)


@query("snapshot_as_of", """select l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey
  from (select *, row_number() over (partition by l_orderkey
    order by l_shipdate desc, l_linenumber desc, l_partkey desc, l_suppkey desc) as rn from lineitem
    where l_shipdate <= timestamp '1998-06-30') where rn = 1""")
def q_as_of(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", *LINE_ORDER)
    past = as_of(lines, F.lit("1998-06-30").cast("timestamp_ntz"), "l_shipdate")
    return latest_per_key(past, ["l_orderkey"], LINE_ORDER)


@query("latest_per_supplier", """select l_suppkey, l_shipdate, l_orderkey, l_linenumber, rank from (
    select *, cast(row_number() over (partition by l_suppkey
      order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_partkey desc) as integer) as rank
    from lineitem) where rank <= 3""")
def q_top_per_key(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    order = [F.col(c).desc_nulls_last() for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")]
    return top_k_per_key(lines, ["l_suppkey"], order, 3).drop("l_partkey")


# --- scorers: users of the event stream, one snapshot per active day ----------------------------


def raw_scorers(spark, sf):
    """Nested scorer snapshots. Assists and penalties are unknown on days without any."""
    kind = F.col("event_type")

    def known(name: str):
        n = F.count_if(kind == name)
        return F.when(n > 0, n)

    daily = table(spark, sf, "events").groupBy("user_id", F.col("ts").cast("date").alias("extraction_date")).agg(
        F.count_if(kind == "purchase").alias("goals"), known("click").alias("assists"),
        known("error").alias("penalties"), F.count(F.lit(1)).alias("playedMatches"),
    )
    customers = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    named = daily.join(customers, F.col("user_id") == F.col("c_custkey"), "left")
    return named.select(
        F.struct(
            F.col("user_id").alias("id"), F.coalesce("c_name", F.col("user_id").cast("string")).alias("name"),
            F.col("n_name").alias("nationality"), F.col("c_mktsegment").alias("section"),
        ).alias("player"),
        F.struct(
            F.col("c_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"),
            F.upper(F.substring("n_name", 1, 3)).alias("tla"), F.lit(None).cast("string").alias("crest"),
        ).alias("team"),
        "playedMatches", "goals", "assists", "penalties",
        F.col("extraction_date").cast("timestamp").alias("extracted_at"), F.lit("events").alias("source"),
        "extraction_date",
    )


SCORERS = """with daily as (
  select user_id, cast(ts as date) as extraction_date, count(*) filter (where event_type = 'purchase') as goals,
    count(*) filter (where event_type = 'click') as assists, count(*) filter (where event_type = 'error') as penalties,
    count(*) as played_matches from events group by all
), scorers as (
  select user_id as player_id, coalesce(c_name, cast(user_id as varchar)) as player_name, n_name as player_nationality,
    c_mktsegment as player_section, cast(c_nationkey as bigint) as team_id, n_name as team_name,
    upper(substr(n_name, 1, 3)) as team_tla, cast(null as varchar) as team_crest_url, played_matches, goals, assists,
    penalties, extraction_date
  from daily left join (customer join nation on n_nationkey = c_nationkey) on c_custkey = user_id
), latest as (
  select * from (select *, row_number() over (partition by player_id order by extraction_date desc) as rn from scorers)
  where rn = 1
), top_scorers as (
  select row_number() over (order by goals desc, penalties, assists desc, player_name, player_id) as rank,
    player_id, player_name, player_nationality, team_id, team_name, team_tla, team_crest_url, played_matches,
    goals, assists, penalties from latest)"""


@query("stage_scorers", SCORERS + " select * from scorers")
def q_stage_scorers(spark, sf):
    return stage_scorers(raw_scorers(spark, sf)).drop("extracted_at")


@query("top_scorers_mart", SCORERS + " select * from top_scorers")
def q_top_scorers_mart(spark, sf):
    return mart_top_scorers(stage_scorers(raw_scorers(spark, sf)))


@query("top_scorers", SCORERS + """ select rank, player_name, player_nationality, team_name, team_tla, team_crest_url,
  played_matches, goals, assists, penalties from top_scorers where rank <= 15""")
def q_top_scorers(spark, sf):
    return X.top_scorers(mart_top_scorers(stage_scorers(raw_scorers(spark, sf))))


# --- run log: one run per user and day ------------------------------------------------------------


def runs(spark, sf):
    status = F.when(F.col("event_type") == "error", "failed").otherwise("ok")
    run = F.concat_ws("/", F.col("user_id").cast("string"), F.col("ts").cast("date").cast("string"))
    return table(spark, sf, "events").select("event_type", run.alias("run_id"), status.alias("status"))


@query("run_summary", """with runs as (select user_id || '/' || cast(ts as date) as run_id,
    max(case when event_type = 'error' then 1 else 0 end) as failed from events group by 1)
  select count(*) as runs_total, count(*) filter (where failed = 0) as runs_ok from runs""")
def q_run_summary(spark, sf):
    return X.run_summary(runs(spark, sf))


@query("archive_days", "select count(distinct cast(ts as date)) as ingestion_days from events")
def q_archive_days(spark, sf):
    return archive_days(table(spark, sf, "events").withColumn("extraction_date", F.col("ts").cast("date")))


@query("newest_load", "select event_type, max(ts) as last_loaded_at, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') as shown from events group by 1")
def q_newest(spark, sf):
    newest = table(spark, sf, "events").groupBy("event_type").agg(F.max("ts").alias("last_loaded_at"))
    return newest.withColumn("shown", display.iso_utc(F.col("last_loaded_at")))


# --- payload shapes and parsing ---------------------------------------------------------------------


@query("payload_documents", """select l_orderkey as id, l_linenumber as line, l_partkey as part,
  case when l_returnflag = 'R' then 3 else 1 end as rows_in_document from lineitem""")
def q_payload_documents(spark, sf):
    """Records counted inside nested documents without exploding them."""
    docs = _line_documents(spark, sf)
    count = payload_row_count("standings").alias("rows_in_document")
    return docs.select("id", "line", "part", count)


def _line_documents(spark, sf):
    """One standings-shaped document per line: a table of one entry, and one of two if returned."""
    entry = F.struct(F.col("l_linenumber").alias("position"), F.col("l_partkey").alias("part"))

    def group(name, *entries):
        return F.struct(name.alias("group"), F.lit("TOTAL").alias("type"), F.array(*entries).alias("table"))

    one, two = group(F.col("l_linestatus"), entry), group(F.col("l_returnflag"), entry, entry)
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"),
        F.when(F.col("l_returnflag") == "R", F.array(one, two)).otherwise(F.array(one)).alias("standings"),
        F.struct(F.lit("TPC").alias("code")).alias("competition"),
        F.struct(F.col("l_orderkey").alias("id")).alias("season"),
    )


@query("standing_rows", """select l_orderkey as order_id, l_linestatus as group_code, 'TPC' as competition,
    l_linenumber as position, l_partkey as part from lineitem
  union all
  select l_orderkey, l_returnflag, 'TPC', l_linenumber, l_partkey from lineitem cross join range(2)
  where l_returnflag = 'R'""")
def q_standing_rows(spark, sf):
    """Nested tables flattened with the context of their group and document."""
    return standing_rows(_line_documents(spark, sf)).select(
        F.col("season.id").alias("order_id"), F.col("standing.group").alias("group_code"),
        F.col("competition.code").alias("competition"), "position", "part",
    )


@query("match_rows", """select l_orderkey as id, l_linenumber as position, l_quantity as quantity from lineitem
  union all select l_orderkey, -l_linenumber, l_tax from lineitem""")
def q_match_rows(spark, sf):
    def record(position, quantity):
        return F.struct(F.col("l_orderkey").alias("id"), position.alias("position"), F.col(quantity).alias("quantity"))

    line = F.col("l_linenumber")
    both = F.array(record(line, "l_quantity"), record(-line, "l_tax"))
    return match_rows(table(spark, sf, "lineitem").select(both.alias("matches")))


@query("numbers_with_units", """select event_id, case when event_type = 'error' then null else value end as parsed from events""")
def q_numbers(spark, sf):
    raw = (
        F.when(F.col("event_type") == "error", "n/a")
        .when(F.col("event_type") == "click", F.concat(F.col("value").cast("string"), F.lit(" km")))
        .when(F.col("event_type") == "view", F.concat(F.lit(" "), F.col("value").cast("string")))
        .otherwise(F.concat(F.col("value").cast("string"), F.lit("%")))
    )
    return table(spark, sf, "events").select("event_id", text.number_with_unit(raw).alias("parsed"))


@query("json_properties", """select event_type, count(*) as n, cast(sum(cast(json_extract(props, '$.k') as bigint)) as bigint) as total_k
  from events group by 1""")
def q_json(spark, sf):
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(k).alias("total_k"))


@query("side_statistics", """select event_id, user_id, case when event_type = 'view' then value else user_id end as own,
    case when event_type = 'view' then user_id else value end as rival from events""")
def q_side_statistics(spark, sf):
    """Own and rival value picked out of nested statistics of each event."""
    item = F.struct(
        F.lit("Expected goals").alias("name"), F.col("value").cast("string").alias("home"),
        F.concat(F.col("user_id").cast("string"), F.lit("%")).alias("away"),
    )
    other = F.struct(F.lit("Fouls").alias("name"), F.lit("1").alias("home"), F.lit("2").alias("away"))
    groups = F.array(F.struct(F.array(other).alias("statisticsItems")), F.struct(F.array(item).alias("statisticsItems")))
    rows = table(spark, sf, "events")
    events = rows.select(
        F.col("event_id").alias("id"), F.col("event_id").alias("startTimestamp"),
        F.struct(F.col("event_type").alias("name")).alias("homeTeam"), "user_id",
    )
    stats = rows.select(
        F.col("event_id").cast("string").alias("id"),
        F.struct(F.array(F.struct(groups.alias("groups"))).alias("statistics")).alias("value"),
    )
    sides = P.event_side_statistics(events, stats, "view")
    users = rows.select(F.col("event_id").alias("id"), "user_id")
    return sides.join(users, "id").select(
        F.col("id").alias("event_id"), "user_id", F.col("xg_for").alias("own"), F.col("xg_against").alias("rival"))


@query("shot_rows", """select o_orderkey as event_id, l_partkey as part, round(l_discount, 3) as xg,
    l_returnflag = 'R' as goal, (l_linestatus = 'O') = (o_orderstatus = 'O') as own
  from orders join lineitem on l_orderkey = o_orderkey""")
def q_shot_rows(spark, sf):
    """Shots unnested from shot maps of orders; lines stand for shots."""
    shot = F.struct(
        F.struct(F.col("l_tax").alias("x"), F.col("l_discount").alias("y")).alias("playerCoordinates"),
        F.col("l_discount").cast("string").alias("xg"),
        F.when(F.col("l_returnflag") == "R", "goal").otherwise("save").alias("shotType"),
        (F.col("l_linestatus") == "O").alias("isHome"),
        F.struct(F.col("l_partkey").cast("string").alias("name")).alias("player"),
    )
    maps = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"), F.struct(F.array(shot).alias("shotmap")).alias("value"))
    events = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.struct(F.col("o_orderstatus").alias("name")).alias("homeTeam"))
    return P.shots(events, maps, "O").select(
        "event_id", F.col("player").cast("long").alias("part"), "xg", "goal", "own")


@query("drifting_union", """select event_id, user_id, event_type, case when event_type in ('purchase', 'click') then value end as value,
    case when event_type is null or event_type not in ('purchase', 'click') then props end as props from events""")
def q_drifting_union(spark, sf):
    """Two layouts, each of its own event types, united by name; what a type's layout lacks is NULL."""
    rows = table(spark, sf, "events")
    valued = F.coalesce(F.col("event_type").isin("purchase", "click"), F.lit(False))
    return union_by_name(
        rows.where(valued).select("event_id", "user_id", "event_type", "value"),
        rows.where(~valued).select("props", "event_type", "event_id", "user_id"),
    )


@query("group_codes", """select r_regionkey, replace(replace('GROUP_' || r_name, 'GROUP_', ''), 'Group ', '') as from_matches,
  replace('Group ' || r_name, 'Group ', '') as from_standings, n_name from region join nation on n_regionkey = r_regionkey""")
def q_group_codes(spark, sf):
    joined = table(spark, sf, "region").join(table(spark, sf, "nation"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        "r_regionkey", text.group_code(F.concat(F.lit("GROUP_"), "r_name")).alias("from_matches"),
        text.group_code(F.concat(F.lit("Group "), "r_name")).alias("from_standings"), "n_name",
    )


@query("contract_violations", """with m as (select o_orderkey as id, case when o_orderstatus = 'O' then null else o_orderstatus end as status,
    case when o_orderpriority = '5-LOW' then null else o_orderpriority end as stage from orders)
  select 'status' as field, count(*) as n_records from m where status is null having count(*) > 0
  union all select 'stage', count(*) from m where stage is null having count(*) > 0""")
def q_contract(spark, sf):
    text_, struct = F.lit("x"), F.struct(F.lit(1).alias("id"))
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), text_.alias("utcDate"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("stage"),
        struct.alias("homeTeam"), struct.alias("awayTeam"), struct.alias("score"), text_.alias("lastUpdated"),
    )
    return contract_violations(rows, "matches")


@query("snapshot_history", """select count(*) as snapshots, count(distinct match_id) as matches from (
    select o_orderkey as match_id, unnest([0, 1]) from orders
    join customer c on c_custkey = o_custkey
    join (select l_orderkey, arg_min(l_suppkey, l_linenumber * 1000000000000 + l_suppkey) as sk from lineitem group by 1) on l_orderkey = o_orderkey
    join supplier on s_suppkey = sk where s_nationkey <> c_nationkey)""")
def q_history(spark, sf):
    return raw_matches(spark, sf).agg(
        F.count(F.lit(1)).alias("snapshots"), F.countDistinct("id").alias("matches"))


@query("leading_customers", "select c_custkey, c_acctbal from customer order by c_acctbal desc, c_custkey limit 15")
def q_leading(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return top_k(rows, [F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey").asc()], 15)
