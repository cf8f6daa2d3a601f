"""Tables written to the shared folder of the session, and the package on every executor."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def one_machine(spark: SparkSession) -> bool:
    """Whether driver and executors are one process; ``local-cluster`` has executors of its own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a private one only in local mode without it."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not one_machine(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Workspace:
    """Intermediate Parquet tables of one job, each in a folder of its own.

    Written tables outlive lost executors, cut lineage and are read as often as needed.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later plan reads."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def filesystem(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it takes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place at once: written beside it, then renamed over what is there."""
    fs, target = filesystem(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.new")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark._jvm.org.apache.hadoop.fs.Options
    overwrite = spark._sc._gateway.new_array(options.Rename, 1)
    overwrite[0] = options.Rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(beside), context.makeQualified(target), overwrite)


BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that workers can import it.

    Rows that workers take are texts, some of them very long, so batches are kept to ``BATCH_ROWS`` and
    ``BATCH_BYTES`` unless the session asks for less.
    """
    sc = spark.sparkContext
    for kind, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{kind}"
        asked = spark.conf.get(name)
        if not asked.isdigit() or not 0 < int(asked) <= most:
            spark.conf.set(name, most)
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{package.name}.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, str(source.relative_to(package.parent)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)
