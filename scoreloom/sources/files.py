"""Typed CSV tables, JSON arrays and serving outputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import enforce_columns
from ..schemas import TEAM_STATS, ddl, mart
from .archive import _exists


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with header and pinned types; a missing file is an empty table."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_statistics_csv(spark: SparkSession, path: str) -> DataFrame:
    """Team statistics; whole numbers may be spelled ``15.0``."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in ddl(TEAM_STATS)])
    raw = read_csv_table(spark, path, text)

    def typed(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return c.cast("double").cast("int").alias(field.name)
        return c.cast(field.dataType).alias(field.name)

    return raw.select(*[typed(f) for f in ddl(TEAM_STATS)])


def pick_columns(wide: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Chosen columns of a wide table under new names."""
    return wide.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def read_json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files holding a JSON array of records; a missing file is an empty table."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, multiLine=True)


def write_csv_table(df: DataFrame, path: str, key: str) -> None:
    """Key-sorted CSV with header; a serving-sized table leaves as one part file."""
    df.coalesce(1).sortWithinPartitions(key).write.mode("overwrite").option("header", True).csv(path)


def write_mart(df: DataFrame, name: str, path: str) -> None:
    """Rebuild a mart table after checking its enforced columns."""
    enforce_columns(df, mart(name), name).write.mode("overwrite").parquet(path)


def write_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
