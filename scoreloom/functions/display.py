"""Display strings and percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def stamp(ts: Column) -> Column:
    """Date and minute with the zone, or a long dash."""
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm' UTC'"), F.lit("—"))


def kickoff(ts: Column) -> Column:
    """Day, short French month and time of day, or a long dash."""
    months = F.array(*[F.lit(m) for m in V.MONTHS_FR])
    text = F.concat(
        F.dayofmonth(ts).cast("string"), F.lit(" "), F.get(months, F.month(ts) - 1),
        F.lit(" · "), F.date_format(ts, "HH:mm"),
    )
    return F.coalesce(text, F.lit("—"))


def score_or_dash(home: Column, away: Column) -> Column:
    text = F.concat(home.cast("string"), F.lit(V.EN_DASH), away.cast("string"))
    return F.coalesce(text, F.lit(V.EN_DASH))


def shootout_text(home: Column, away: Column) -> Column:
    """Kicks of both sides with the mark of a shootout; NULL without one."""
    return F.concat(
        home.cast("string"), F.lit(V.EN_DASH), away.cast("string"), F.lit(f" {V.SHOOTOUT_MARK}")
    )


def group_label(code: Column) -> Column:
    return F.concat(F.lit("Groupe "), code)


def stage_name(stage: Column) -> Column:
    pairs = [F.lit(x) for kv in V.STAGE_NAMES_FR.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), stage), stage)


def signed(n: Column) -> Column:
    return F.concat(F.when(n > 0, "+").otherwise(""), n.cast("string"))


def percent(p: Column) -> Column:
    return F.round(p * 100).cast("int")


def short_label(name: Column) -> Column:
    return F.upper(F.substring(name, 1, 3))
