"""Dated snapshot archive: nested Parquet, one partition per extraction day.

A day is written as a load of its own under the day's partition, counted, and only then published: a small
file per day names the load that counts and its number of rows. A load that fails leaves the day as it
was; readers see the old load or the new one, never a mixture. Loads that no day names any more are
removed by ``remove_old_loads``.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterable, Iterator
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import contract_report, require_contract
from ..operators.reshape import union_by_name
from ..schemas import DATASETS, archive_schema, raw_rows
from ..shared_store import filesystem, replace_file, ship_package
from .stores import store

log = logging.getLogger(__name__)


class RowCountMismatch(Exception):
    """What was written holds another number of rows than were handed over."""


PUBLISHED = "_published"
CATALOG = "dataset STRING, extraction_date DATE, load STRING, rows BIGINT, extracted_at TIMESTAMP"


def _dataset_path(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{dataset}"


def _cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns cast to their declared type (absent ones NULL), others kept."""
    have = set(df.columns)
    declared = [
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    names = {f.name for f in schema}
    return df.select(*declared, *[f"`{c}`" for c in df.columns if c not in names])


def write_archive(
    rows: DataFrame, dataset: str, root: str, extracted_at: datetime, source: str,
    validate: bool = True,
) -> str | None:
    """Replace the day's rows; other days stay untouched.

    The contract is checked before the write. Rows are counted while they are written and compared with
    what the written files hold; only then the day is switched to them. Declared columns always carry their
    declared type, so a day without a single value stays readable beside the others; undeclared columns are
    archived as they come. Nothing is written for an empty input. Returns the path of the load.
    """
    if rows.isEmpty():
        log.warning("%s: 0 rows received, nothing written", dataset)
        return None
    if validate:
        report = contract_report(rows.limit(0), dataset)
        if not report.checked:
            log.warning("%s: no contract declared, rows pass unchecked", dataset)
        elif report.unknown:
            log.info("%s: fields outside the contract: %s", dataset, ", ".join(report.unknown))
        require_contract(rows, dataset)
    day = extracted_at.date()
    shaped = _cast_to(rows, raw_rows(dataset)) if dataset in DATASETS else rows
    seen = Observation()
    load = f"extraction_date={day.isoformat()}/load={uuid.uuid4().hex}"
    target = f"{_dataset_path(root, dataset)}/{load}"
    (
        shaped.withColumn("extracted_at", F.lit(extracted_at).cast("timestamp"))
        .withColumn("source", F.lit(source))
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.parquet(target)
    )
    publish(rows.sparkSession, dataset, root, day, load, seen.get["rows"], extracted_at)
    return target


def publish(spark: SparkSession, dataset: str, root: str, day: date, load: str, rows: int, extracted_at: datetime) -> None:
    """Switch a day to a written load, once it holds as many rows as were handed over."""
    base = _dataset_path(root, dataset)
    written = spark.read.parquet(f"{base}/{load}").count()
    if written != rows:
        raise RowCountMismatch(f"{dataset}: {rows} rows in, {written} rows written")
    entry = {"dataset": dataset, "extraction_date": day.isoformat(), "load": load, "rows": rows, "extracted_at": extracted_at.isoformat()}
    replace_file(spark, f"{base}/{PUBLISHED}/{day.isoformat()}.json", json.dumps(entry))


def archive_catalog(spark: SparkSession, dataset: str, root: str) -> DataFrame:
    """The published days with their rows, without reading an archived row: one small file a day."""
    path = f"{_dataset_path(root, dataset)}/{PUBLISHED}"
    if not _exists(spark, path):
        return spark.createDataFrame([], CATALOG)
    return spark.read.schema(CATALOG).option("pathGlobFilter", "*.json").option("mode", "FAILFAST").json(path)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = filesystem(spark, path)
    return fs.exists(hadoop_path)


def read_archive(spark: SparkSession, dataset: str, root: str) -> DataFrame:
    """All published days of an archive written by ``write_archive``; empty when there are none."""
    schema = archive_schema(dataset)
    loads = [r["load"] for r in archive_catalog(spark, dataset, root).select("load").collect()]  # one a day
    if not loads:
        return spark.createDataFrame([], schema)
    base = _dataset_path(root, dataset)
    whole = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    found = spark.read.schema(whole).option("basePath", base).parquet(*[f"{base}/{load}" for load in loads])
    return found.drop("load")


def remove_old_loads(spark: SparkSession, dataset: str, root: str) -> list[str]:
    """Delete the loads that no day names; call it when nobody reads an old state any more."""
    base = _dataset_path(root, dataset)
    current = {r["load"] for r in archive_catalog(spark, dataset, root).select("load").collect()}
    fs, hadoop_path = filesystem(spark, f"{base}/extraction_date=*/load=*")
    found = fs.globStatus(hadoop_path) or []
    removed = []
    for status in found:
        at = status.getPath()
        load = f"{at.getParent().getName()}/{at.getName()}"
        if load not in current:
            fs.delete(at, True)
            removed.append(load)
    return sorted(removed)


def file_layouts(spark: SparkSession, day_paths: Iterable[str]) -> DataFrame:
    """Every Parquet file under the days with its layout, read from the footers by tasks."""
    ship_package(spark)
    days = spark.createDataFrame([(p,) for p in day_paths], "day STRING")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, layouts = [], []
            for day in batch.column("day").to_pylist():
                for name, system, place in store(day).files(".parquet"):
                    with system.open_input_file(place) as f:
                        fields = pq.read_schema(f)
                    files.append(f"{day.rstrip('/')}/{name}")
                    layouts.append("; ".join(f"{x.name} {x.type}" for x in fields))
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(layouts, pa.string())], ["file", "layout"])

    return days.mapInArrow(run, "file string, layout string")


def read_foreign_days(
    spark: SparkSession, dataset: str, root: str, day_paths: Iterable[str]
) -> DataFrame:
    """Days written by others, whose layouts drift (a column absent, or typed as NULL).

    Files of one layout are one scan, cast to the contract and united by name with the others, so the
    plan grows with the number of layouts and not with that of days.
    """
    base = _dataset_path(root, dataset)
    schema = archive_schema(dataset)
    by_layout = file_layouts(spark, day_paths).groupBy("layout").agg(F.sort_array(F.collect_list("file")).alias("files"))
    layouts = by_layout.orderBy("layout").collect()  # the names of the files to read
    scans = [_cast_to(spark.read.option("basePath", base).parquet(*r["files"]), schema) for r in layouts]
    return union_by_name(*scans) if scans else spark.createDataFrame([], schema)


def archive_days(archive: DataFrame) -> DataFrame:
    """Number of extraction days present; on a partition column only metadata is distinct."""
    days = archive.select("extraction_date").distinct()
    return days.agg(F.count(F.lit(1)).alias("ingestion_days"))
