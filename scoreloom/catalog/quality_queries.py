"""Checks that return failing rows, and reconciliation of independent sources."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import reconcile as C
from .contests import FACTS, facts
from .registry import query, table


@query("check_not_null", FACTS + " select match_id, status from facts where regulation_home_goals is null")
def q_not_null(spark, sf):
    return Q.not_null(facts(spark, sf), "regulation_home_goals").select("match_id", "status")


@query("check_not_null_scoped", FACTS + """ select match_id, stage from facts
  where group_code is null and status = 'FINISHED'""")
def q_not_null_scoped(spark, sf):
    return Q.not_null(facts(spark, sf), "group_code", "status = 'FINISHED'").select("match_id", "stage")


@query("check_unique", """select l_orderkey, count(*) as n_records from lineitem
  where l_orderkey is not null group by l_orderkey having count(*) > 1""")
def q_unique(spark, sf):
    return Q.unique(table(spark, sf, "lineitem"), "l_orderkey")


@query("check_unique_combination", """select l_orderkey, l_linenumber, count(*) as n_records from lineitem
  group by all having count(*) > 1""")
def q_unique_combination(spark, sf):
    return Q.unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_accepted_values", FACTS + """ select stage as value_field, count(*) as n_records from facts
  where stage not in ('GROUP_STAGE', 'SEMI_FINALS', 'FINAL') group by stage""")
def q_accepted_values(spark, sf):
    return Q.accepted_values(facts(spark, sf), "stage", ["GROUP_STAGE", "SEMI_FINALS", "FINAL"])


@query("check_accepted_range", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
  from lineitem where l_quantity < 5 or l_quantity > 45""")
def q_accepted_range(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return Q.accepted_range(lines, "l_quantity", 5, 45)


@query("check_relationships", """select o_orderkey, o_custkey from orders o
  where o_custkey is not null and not exists (select 1 from events e where e.user_id = o.o_custkey)""")
def q_relationships(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return Q.relationships(orders, "o_custkey", table(spark, sf, "events"), "user_id")


@query("check_row_count", FACTS + " select count(*) as actual_row_count from facts having count(*) <> 104")
def q_row_count(spark, sf):
    return Q.row_count_equals(facts(spark, sf), 104)


@query("check_kickoff_window", FACTS + """ select match_id, kickoff_at from facts
  where kickoff_at is not null and kickoff_at::date not between date '1996-06-11' and date '1999-07-19'""")
def q_window(spark, sf):
    bad = Q.within_window(facts(spark, sf), "kickoff_at", date(1996, 6, 11), date(1999, 7, 19))
    return bad.select("match_id", "kickoff_at")


# What the goals should be, side by side with what they are.
EXPECTED_GOALS = FACTS + """, expected as (
  select *, case duration when 'PENALTY_SHOOTOUT' then 1 else 0 end as shot,
    [full_time_home_goals - shot * coalesce(penalty_home_goals, 0), full_time_away_goals - shot * coalesce(penalty_away_goals, 0)] as wanted,
    [regulation_home_goals, regulation_away_goals] as found
  from facts where full_time_home_goals is not null)"""


@query("check_regulation_goals", EXPECTED_GOALS + " select match_id, duration from expected where wanted is distinct from found")
def q_regulation(spark, sf):
    return Q.regulation_goals(facts(spark, sf)).select("match_id", "duration")


@query("check_regulation_goals_fault", FACTS + """ select match_id, duration from facts
  where duration = 'PENALTY_SHOOTOUT' and (penalty_home_goals <> 0 or penalty_away_goals <> 0)""")
def q_regulation_fault(spark, sf):
    """The same check where totals were taken for goals: every shootout with kicks must show."""
    wrong = facts(spark, sf).withColumns({
        "regulation_home_goals": F.col("full_time_home_goals"),
        "regulation_away_goals": F.col("full_time_away_goals"),
    })
    return Q.regulation_goals(wrong).select("match_id", "duration")


@query("check_involves", FACTS + " select match_id from facts where home_team_id <> 7 and away_team_id <> 7")
def q_involves(spark, sf):
    return Q.involves(facts(spark, sf), 7, "home_team_id", "away_team_id").select("match_id")


def _checks(spark, sf):
    rows = facts(spark, sf)
    return [
        Q.TableCheck("match_unique", rows, key="match_id"),
        Q.TableCheck("kickoff_set", rows, F.col("kickoff_at").isNull()),
        Q.TableCheck("goals_set", rows, F.col("regulation_home_goals").isNull(), severity="warn"),
        Q.TableCheck("goals_range", rows, Q.outside("full_time_home_goals", 0, 5)),
        Q.TableCheck("regulation", rows, Q.regulation_fault()),
    ]


CHECKS = EXPECTED_GOALS + """, counted as (
  select 'match_unique' as "check", (select count(*) from (select match_id from facts group by 1 having count(*) > 1)) as failures, 'error' as s
  union all select 'kickoff_set', (select count(*) from facts where kickoff_at is null), 'error'
  union all select 'goals_set', (select count(*) from facts where regulation_home_goals is null), 'warn'
  union all select 'goals_range', (select count(*) from facts where full_time_home_goals < 0 or full_time_home_goals > 5), 'error'
  union all select 'regulation', (select count(*) from expected where wanted is distinct from found), 'error'
), results as (select "check", failures, case when failures = 0 then 'pass' else s end as status from counted)"""


@query("check_results", CHECKS + " select * from results")
def q_check_results(spark, sf):
    return Q.run_checks(_checks(spark, sf))


@query("check_summary", CHECKS + """ select count(*) filter (where status in ('pass', 'success')) as passed,
  count(*) as total from results""")
def q_check_summary(spark, sf):
    return Q.passed_and_total(Q.run_checks(_checks(spark, sf)))


@query("freshness", """with last as (select user_id, max(ts) as last_loaded_at from events group by user_id),
  aged as (select *, (epoch_us(timestamp '2024-02-01 00:00:00') - epoch_us(last_loaded_at)) / 3600e6 as h from last)
  select user_id, last_loaded_at, round(h, 3) as age_hours,
    case when last_loaded_at is null or h > 48 then 'error' when h > 26 then 'warn' else 'pass' end as status from aged""")
def q_freshness(spark, sf):
    return Q.freshness(table(spark, sf, "events"), datetime(2024, 2, 1), "ts", by=["user_id"])


# --- reconciliation ---------------------------------------------------------------------------


@query("names_in_one_source", """with users as (select distinct 'Customer#' || lpad(cast(user_id as varchar), 9, '0') as c_name from events)
  select c_name, 'customers' as only_in from (select c_name from customer except select c_name from users)
  union all select c_name, 'users' from (select c_name from users except select c_name from customer)""")
def q_names(spark, sf):
    users = table(spark, sf, "events").select("user_id").distinct().select(_customer_name("user_id").alias("c_name"))
    return C.unmatched_both_ways(table(spark, sf, "customer"), users, ["c_name"], ("customers", "users"))


def _customer_name(key: str):
    return F.concat(F.lit("Customer#"), F.lpad(F.col(key).cast("string"), 9, "0"))


@query("alias_lookup", """select s_suppkey, s_name, coalesce(c_name, s_name) as canonical_name
  from supplier left join customer on c_custkey = s_suppkey and c_acctbal > 0""")
def q_alias_lookup(spark, sf):
    """Supplier names brought to the spelling of the customer with the same number."""
    named = table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.concat(F.lit("Supplier#"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("source_name"),
        F.col("c_name").alias("canonical_name"),
    )
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return C.with_canonical_name(suppliers, "s_name", named, "canonical_name")


@query("alias_faults", """with aliases as (select p_name as source_name, p_type as canonical_name from part)
  select source_name, 'unknown source name' as fault from aliases
    where source_name not in (select p_name from part where p_size > 25)
  union all
  select source_name, 'shared canonical name' from aliases where canonical_name in (
    select canonical_name from aliases group by 1 having count(*) > 1)""")
def q_alias_faults(spark, sf):
    parts = table(spark, sf, "part")
    aliases = parts.select(F.col("p_name").alias("source_name"), F.col("p_type").alias("canonical_name"))
    known = parts.where("p_size > 25").select(F.col("p_name").alias("source_name")).distinct()
    return Q.alias_faults(aliases, known)


@query("merge_one_to_one", """select n_name, customers, balance, suppliers, orders from nation
  left join (select c_nationkey, count(*) as customers, round(sum(c_acctbal), 2) as balance from customer group by 1)
    on c_nationkey = n_nationkey
  left join (select s_nationkey, count(*) as suppliers from supplier group by 1) on s_nationkey = n_nationkey
  left join (select c_nationkey as k, count(*) as orders from orders join customer on c_custkey = o_custkey group by 1)
    on k = n_nationkey""")
def q_merge(spark, sf):
    nation, customer = table(spark, sf, "nation"), table(spark, sf, "customer")
    names = nation.select(F.col("n_nationkey").alias("key"), "n_name")
    orders = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    n = F.count(F.lit(1))
    parts = [
        names,
        customer.groupBy(F.col("c_nationkey").alias("key")).agg(
            n.alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")),
        table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("key")).agg(n.alias("suppliers")),
        orders.groupBy(F.col("c_nationkey").alias("key")).agg(n.alias("orders")),
    ]
    return C.merge_one_to_one(parts, "key", missing="keep").drop("key")


@query("chronological_pairs", """with o as (
    select o_custkey as entity, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as step from orders),
  e as (select user_id as entity, event_id, row_number() over (partition by user_id order by ts, event_id) as step from events)
  select coalesce(o.entity, e.entity) as entity, coalesce(o.step, e.step) as step,
    o.o_orderkey as order_key, e.event_id as event_key
  from o full outer join e on e.entity = o.entity and e.step = o.step""")
def q_chronological(spark, sf):
    """A customer's n-th order beside the same user's n-th event."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("entity"), "o_orderdate", "o_orderkey")
    events = table(spark, sf, "events").select(F.col("user_id").alias("entity"), "ts", "event_id")
    paired = C.paired_by_order(
        orders, events, ["entity"], [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()],
        [F.col("ts").asc(), F.col("event_id").asc()], ("o", "e"),
    )
    return paired.select(
        "entity", "step", F.col("o_o_orderkey").alias("order_key"), F.col("e_event_id").alias("event_key")
    )


@query("anti_join_suppliers", """select s_suppkey, s_name from supplier
  where s_suppkey not in (select l_suppkey from lineitem where l_returnflag = 'R' and l_quantity > 49)""")
def q_anti_join(spark, sf):
    """Suppliers without a fully returned line."""
    returned = table(spark, sf, "lineitem").where("l_returnflag = 'R' and l_quantity > 49")
    suppliers = table(spark, sf, "supplier")
    return C.unmatched(
        suppliers.select("s_suppkey", "s_name").withColumnRenamed("s_suppkey", "key"),
        returned.select(F.col("l_suppkey").alias("key")), ["key"],
    ).withColumnRenamed("key", "s_suppkey").join(suppliers.select("s_suppkey", "s_name"), "s_suppkey")
