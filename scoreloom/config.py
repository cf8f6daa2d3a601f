"""Session settings, per-edition parameters and the lineage-cutting helper."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from .shared_store import shared_folder


@dataclass(frozen=True)
class Edition:
    """Everything that pins a run to one edition of a competition."""

    year: int
    host: str
    expected_matches: int
    expected_teams: int
    expected_scorers: int
    starts_on: date
    ends_on: date
    direct_places: int = 2
    extra_place_position: int = 3
    extra_places: int = 8


def session(app: str = "scoreloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC timestamps, ANSI arithmetic and adaptive execution."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the folder the cluster names.

    ``spark.checkpoint.dir`` is honoured when set. Only a local-mode session without the
    setting (tests) gets a private folder; on a cluster its absence is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
