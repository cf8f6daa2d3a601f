"""Append-only JSON-lines log of pipeline runs."""

from __future__ import annotations

import logging
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RUN_LOG, ddl
from .archive import _exists

log = logging.getLogger(__name__)

ERROR_LENGTH = 300


def record_run(
    spark: SparkSession, path: str, *, run_id: str, stage: str, dataset: str, rows: int,
    duration_s: float, status: str = "ok", error: str | None = None,
) -> dict[str, Any]:
    """Append one record. A log that cannot be written is reported, never raised."""
    now = datetime.now(UTC).isoformat(timespec="seconds")
    values = (run_id, now, stage, dataset, rows, float(duration_s), status, error or None)
    row = (
        spark.createDataFrame([values], RUN_LOG)
        .withColumn("duration_s", F.round("duration_s", 2))
        .withColumn("error", F.substring("error", 1, ERROR_LENGTH))
    )
    record = row.first().asDict()
    try:
        row.coalesce(1).write.mode("append").json(path)
    except Exception:  # any storage failure must leave a healthy run healthy
        log.exception("could not append to the run log at %s", path)
    if record["error"] is None:
        del record["error"]
    return record


MALFORMED = "_malformed"


def split_runs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The records of a log, and the lines that are none (column ``line``); blank lines are neither."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    shape = T.StructType([*ddl(RUN_LOG).fields, T.StructField(MALFORMED, T.StringType())])
    parsed = lines.select("value", F.from_json("value", shape, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}).alias("r"))
    broken = F.col("r").isNull() | F.col(f"r.{MALFORMED}").isNotNull()
    return parsed.where(~broken).select("r.*").drop(MALFORMED), parsed.where(broken).select(F.col("value").alias("line"))


def read_runs(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Records in order of time; blank and malformed lines are skipped, ``split_runs`` has the latter.

    ``limit`` keeps the last records. A missing log is an empty table.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], RUN_LOG)
    runs = split_runs(spark, path)[0]
    if limit:
        newest = [F.col(c).desc_nulls_last() for c in ("recorded_at", "run_id", "stage", "dataset")]
        runs = runs.orderBy(*newest).limit(limit)
    return runs.orderBy(*[F.col(c).asc_nulls_last() for c in ("recorded_at", "run_id", "stage", "dataset")])
