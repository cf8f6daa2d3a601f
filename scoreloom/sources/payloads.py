"""Landed JSON payloads: one document per file, one row per nested record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import payload as payload_schema


def read_payload(spark: SparkSession, dataset: str, path: str) -> DataFrame:
    return spark.read.schema(payload_schema(dataset)).json(path, multiLine=True)


def match_rows(payload: DataFrame) -> DataFrame:
    return payload.select(F.inline("matches"))


def scorer_rows(payload: DataFrame) -> DataFrame:
    return payload.select(F.inline("scorers"))


def standing_rows(payload: DataFrame) -> DataFrame:
    """One row per table entry; its group, competition and season travel along."""
    groups = payload.select("competition", "season", F.explode("standings").alias("g"))
    context = [f.name for f in groups.schema["g"].dataType if f.name != "table"]
    return groups.select(
        F.explode("g.table").alias("entry"),
        F.struct(*[F.col("g").getField(c).alias(c) for c in context]).alias("standing"),
        "competition",
        "season",
    ).select("entry.*", "standing", "competition", "season")


def payload_row_count(dataset: str) -> Column:
    """Number of records in a payload document, without exploding it."""
    if dataset != "standings":
        return F.coalesce(F.size(F.col(dataset)), F.lit(0))
    sizes = F.transform("standings", lambda g: F.coalesce(F.size(g["table"]), F.lit(0)))
    return F.coalesce(F.aggregate(sizes, F.lit(0), lambda a, n: a + n), F.lit(0))


ROWS = {"matches": match_rows, "standings": standing_rows, "scorers": scorer_rows}
