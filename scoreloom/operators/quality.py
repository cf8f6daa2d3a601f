"""Data-quality checks: each returns the failing rows; a runner counts them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V
from ..schemas import CORE_FIELDS


def _scope(df: DataFrame, where: Column | str | None) -> DataFrame:
    return df if where is None else df.where(where)


def not_null(df: DataFrame, column: str, where=None) -> DataFrame:
    return _scope(df, where).where(F.col(column).isNull())


def unique(df: DataFrame, columns: str | Sequence[str], where=None) -> DataFrame:
    """Repeated keys with their count; a single NULL key is not a repeat."""
    keys = [columns] if isinstance(columns, str) else list(columns)
    scope = _scope(df, where)
    if len(keys) == 1:
        scope = scope.where(F.col(keys[0]).isNotNull())
    return scope.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence[Any], where=None) -> DataFrame:
    """Values outside the list with their count; NULL is accepted."""
    return (
        _scope(df, where)
        .where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def accepted_range(df: DataFrame, column: str, low=None, high=None, where=None) -> DataFrame:
    """Rows outside [low, high]; a NULL value counts as outside nothing."""
    return _scope(df, where).where(outside(column, low, high))


def outside(column: str, low=None, high=None) -> Column:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return bad


def relationships(
    child: DataFrame, column: str, parent: DataFrame, field: str, also: Sequence[str] = ()
) -> DataFrame:
    """Child rows whose key is absent in the parent; NULL keys are ignored.

    ``also`` lists key columns both sides share, such as the competition.
    """
    keys = parent.select(F.col(field).alias(column), *also).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, [column, *also], "left_anti")


def row_count_equals(df: DataFrame, expected: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("actual_row_count")).where(
        F.col("actual_row_count") != expected
    )


def within_window(df: DataFrame, column: str, start, end_day) -> DataFrame:
    """Rows before ``start`` or after the whole of ``end_day``."""
    first = F.lit(str(start)).cast("timestamp_ntz")
    past = F.lit(str(end_day)).cast("timestamp_ntz") + F.expr("interval 1 day")
    return df.where((F.col(column) < first) | (F.col(column) >= past))


def regulation_fault() -> Column:
    """Whether regulation goals are not the reported goals less shootout kicks."""
    bad = F.lit(False)
    shootout = F.coalesce(F.col("duration"), F.lit("")) == V.SHOOTOUT
    for side in ("home", "away"):
        total = F.col(f"full_time_{side}_goals")
        kicks = F.coalesce(F.col(f"penalty_{side}_goals"), F.lit(0))
        expected = F.when(shootout, total - kicks).otherwise(total)
        bad = bad | (F.col(f"regulation_{side}_goals") != expected)
    return F.col("full_time_home_goals").isNotNull() & bad


def regulation_goals(df: DataFrame) -> DataFrame:
    """Matches whose regulation goals are not the reported goals less shootout kicks."""
    return df.where(regulation_fault())


def involves(df: DataFrame, subject_id: Any, home: str, away: str) -> DataFrame:
    """Events in which the subject does not take part."""
    return df.where((F.col(home) != subject_id) & (F.col(away) != subject_id))


# --- schemas and contracts ---------------------------------------------------------------


class SchemaContractError(Exception):
    """Core fields are missing, mistyped or null."""


def enforce_columns(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Names, order and types must be exactly the declared ones."""
    want = [(f.name, f.dataType.simpleString()) for f in schema]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    if want != have:
        raise SchemaContractError(
            f"{name}: missing or retyped {sorted(set(want) - set(have))}, "
            f"unexpected {sorted(set(have) - set(want))}"
        )
    return df


@dataclass(frozen=True)
class ContractReport:
    checked: bool
    unknown: tuple[str, ...] = ()
    violations: tuple[str, ...] = ()


_SHOWN = 10


def contract_report(df: DataFrame, dataset: str) -> ContractReport:
    """Missing, mistyped and null core fields of the whole input, counted in one pass."""
    core = CORE_FIELDS.get(dataset)
    if core is None:
        return ContractReport(checked=False)
    have = {f.name: f.dataType for f in df.schema}
    violations, must_fill = [], []
    for name, (kind, nullable) in core.items():
        if name not in have:
            violations.append(f"'{name}' was not delivered")
            continue
        actual = have[name].simpleString().split("<")[0]
        if isinstance(have[name], T.NullType):
            actual = "void"
        if actual != kind and not (actual == "void" and nullable):
            want = kind + ("" if not nullable else " | null")
            violations.append(f"'{name}' is {actual} where {want} is agreed")
        elif not nullable:
            must_fill.append(name)
    if must_fill:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in must_fill]).first()
        violations += [f"'{c}' is null in {nulls[c]} row(s)" for c in must_fill if nulls[c]]
    unknown = tuple(sorted(set(have) - set(core)))
    return ContractReport(True, unknown, tuple(violations))


def require_contract(df: DataFrame, dataset: str) -> DataFrame:
    """Stop before anything is written when a core field is unusable; name every fault."""
    found = contract_report(df, dataset).violations
    if found:
        more = f" (+{len(found) - _SHOWN} more)" if len(found) > _SHOWN else ""
        raise SchemaContractError(
            f"{dataset}: {len(found)} contract violation(s): {'; '.join(found[:_SHOWN])}{more}"
        )
    return df


def contract_violations(df: DataFrame, dataset: str) -> DataFrame:
    """Row-level form: every (field, count) of null core fields, as failing rows."""
    fields = [n for n, (_, nullable) in CORE_FIELDS[dataset].items() if not nullable]
    checks = F.array(
        *[F.struct(F.lit(n).alias("field"), F.col(n).isNull().alias("bad")) for n in fields]
    )
    return (
        df.select(F.inline(checks)).where("bad")
        .groupBy("field").agg(F.count(F.lit(1)).alias("n_records"))
    )


def output_contract(df: DataFrame, required: Iterable[str], name: str) -> list[str]:
    """Faults of a serving extract: absent columns or no rows."""
    faults = [f"{name}: missing column '{c}'" for c in required if c not in df.columns]
    if df.isEmpty():
        faults.append(f"{name}: empty")
    return faults


def alias_faults(aliases: DataFrame, source_names: DataFrame) -> DataFrame:
    """Alias keys unknown to the source, and canonical names used twice."""
    unknown = (
        aliases.join(source_names.select("source_name"), "source_name", "left_anti")
        .select("source_name", F.lit("unknown source name").alias("fault"))
    )
    shared = aliases.groupBy("canonical_name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = aliases.join(shared, "canonical_name").select(
        "source_name", F.lit("shared canonical name").alias("fault")
    )
    return unknown.unionByName(repeated)


# --- freshness and run summary -----------------------------------------------------------


def freshness(
    df: DataFrame, now: datetime | Column, column: str = "extracted_at",
    warn_hours: int = V.WARN_AFTER_HOURS, error_hours: int = V.ERROR_AFTER_HOURS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Newest load per key with pass / warn / error by its age at ``now``."""
    at = now if isinstance(now, Column) else F.lit(now)
    hours = (F.unix_micros(at.cast("timestamp")) - F.unix_micros(
        F.col("last_loaded_at").cast("timestamp"))) / F.lit(3600.0 * 1e6)
    status = (
        F.when(F.col("last_loaded_at").isNull() | (hours > error_hours), "error")
        .when(hours > warn_hours, "warn")
        .otherwise("pass")
    )
    return (
        df.groupBy(*by).agg(F.max(column).alias("last_loaded_at"))
        .withColumn("age_hours", F.round(hours, 3))
        .withColumn("status", status)
    )


@dataclass(frozen=True)
class Check:
    """Rows that must not be there: ``failing`` lists them, at the price of a pass of its own."""

    name: str
    failing: DataFrame
    severity: str = "error"


@dataclass(frozen=True, eq=False)
class TableCheck:
    """A check as data, judged together with the others of its table.

    One of: ``bad``, true for a failing row; ``key``, a column without repeats (NULL is no repeat);
    ``rows``, the number of rows; ``values``, a column and all it may hold beside NULL (failures
    are different other values).
    """

    name: str
    table: DataFrame
    bad: Column | None = None
    key: str | None = None
    rows: int | None = None
    values: tuple[str, Sequence[Any]] | None = None
    severity: str = "error"


def _number(check: TableCheck) -> str:
    return "_" + check.name


def _together(table: DataFrame, checks: Sequence[TableCheck]) -> list[DataFrame]:
    """One row with the failures of each check: a single pass, and one more for each further key or for values.

    The pass groups by the first key, as its check has to, and carries the failing rows of the others along.
    """
    counted = [c for c in checks if c.bad is not None]
    sized = [c for c in checks if c.rows is not None]
    keys = [c for c in checks if c.key is not None]
    listed = [c for c in checks if c.values is not None]
    parts = []
    total = {c: F.when(F.sum("_n") != c.rows, 1).otherwise(0) for c in sized}
    if keys:
        first = keys[0]
        by_key = table.groupBy(F.col(first.key).alias("_key")).agg(
            F.count(F.lit(1)).alias("_n"), *[F.count_if(c.bad).alias(_number(c)) for c in counted])
        parts.append((by_key, {first: F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1))}))
    elif counted or sized:
        parts.append((table.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(c.bad).alias(_number(c)) for c in counted]), {}))
    if parts:
        parts[0][1].update(total | {c: F.sum(_number(c)) for c in counted})
    for c in keys[1:]:
        repeats = table.groupBy(F.col(c.key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
        parts.append((repeats, {c: F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1))}))
    if listed:
        parts.append((table, {c: F.count_distinct(F.when(~F.col(c.values[0]).isin(*c.values[1]), F.col(c.values[0]))) for c in listed}))
    out = []
    for rows, found in parts:
        judged = [F.struct(F.lit(c.name).alias("check"), F.coalesce(F.col(_number(c)), F.lit(0)).cast("long").alias("failures"), F.lit(c.severity).alias("severity"))
                  for c in found]
        out.append(rows.agg(*[e.alias(_number(c)) for c, e in found.items()]).select(F.inline(F.array(*judged))))
    return out


def run_checks(checks: Sequence[Check | TableCheck]) -> DataFrame:
    """One row per check: failures and status. Checks of one table share a pass over it."""
    tables: dict[int, list[TableCheck]] = {}
    parts = []
    for c in checks:
        if isinstance(c, TableCheck):
            tables.setdefault(id(c.table), []).append(c)
        else:
            parts.append(c.failing.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(c.name).alias("check"), "failures", F.lit(c.severity).alias("severity")))
    for own in tables.values():
        parts += _together(own[0].table, own)
    return reduce(DataFrame.unionByName, parts).select(
        "check", "failures", F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity")).alias("status"))


def passed_and_total(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("status").isin("pass", "success")).alias("passed"),
        F.count(F.lit(1)).alias("total"),
    )


def mart_checks(
    marts: Mapping[str, DataFrame], expected: Mapping[str, int], group_codes: Sequence[str]
) -> list[Check | TableCheck]:
    """The standing assertions over the star schema."""
    teams, facts = marts["dim_teams"], marts["fct_matches"]
    table, scorers = marts["fct_group_standings"], marts["mart_top_scorers"]
    def label(mart: DataFrame) -> str:
        return next(k for k, v in marts.items() if v is mart)

    checks: list[Check | TableCheck] = [TableCheck(f"{m}_rows", marts[m], rows=n) for m, n in expected.items()]
    for mart, key in ((teams, "team_id"), (facts, "match_id"), (scorers, "rank"), (scorers, "player_id")):
        checks.append(TableCheck(f"{label(mart)}_{key}_unique", mart, key=key))
        checks.append(TableCheck(f"{label(mart)}_{key}_not_null", mart, F.col(key).isNull()))
    checks += [
        TableCheck(f"fct_matches_{c}_range", facts, outside(c, 0, 12))
        for c in (
            "full_time_home_goals", "full_time_away_goals",
            "regulation_home_goals", "regulation_away_goals",
        )
    ]
    checks += [
        TableCheck("fct_matches_kickoff_not_null", facts, F.col("kickoff_at").isNull()),
        TableCheck("fct_matches_winner", facts, values=("winner", V.WINNERS)),
        TableCheck("fct_matches_stage", facts, values=("stage", V.STAGES)),
        TableCheck("fct_matches_status", facts, values=("status", V.STATUSES)),
        TableCheck("fct_matches_regulation", facts, regulation_fault()),
        Check("fct_matches_home_team", relationships(facts, "home_team_id", teams, "team_id")),
        Check("fct_matches_away_team", relationships(facts, "away_team_id", teams, "team_id")),
        Check("standings_key", unique(table, ["group_code", "team_id"])),
        Check("standings_team", relationships(table, "team_id", teams, "team_id")),
        TableCheck("standings_group", table, values=("group_code", group_codes)),
        TableCheck("standings_position", table, values=("position", (1, 2, 3, 4))),
        TableCheck("standings_points", table, outside("points", 0, 9)),
        Check("scorers_team", relationships(scorers, "team_id", teams, "team_id")),
        TableCheck("scorers_goals_not_null", scorers, F.col("goals").isNull()),
    ]
    if "mart_edition_comparison" in marts:
        editions = marts["mart_edition_comparison"]
        checks += [
            TableCheck("editions_year", editions, key="year"),
            TableCheck("editions_rate", editions, outside("goals_per_match", 1.5, 6.0)),
            TableCheck("editions_rank", editions, key="goals_per_match_rank"),
        ]
    return checks
