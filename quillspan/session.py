"""Sessions: where Python workers find this package, and tables in the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Put the package's folder on the workers' path; on a cluster without a shared installation, submit it with ``--py-files`` as well."""
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


#: Folders made for sessions that name none, by application.
_OWN: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """The folder all executors share; one of our own only in local mode, where the session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = spark.sparkContext.applicationId
        if own not in _OWN:
            _OWN[own] = "file://" + tempfile.mkdtemp(prefix="quillspan-")
        folder = _OWN[own]
    return folder


#: Shuffle files of a finished query go at once, not when the JVM happens to collect its plan.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives the loss of any executor. The table goes when the session's JVM ends.

    The shuffle files behind the table go as soon as it is written.
    """
    return write_and_read(df, name)[0]


def write_and_read(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`materialise`, with the table's path for :func:`discard`."""
    spark = df.sparkSession
    path = f"{scratch(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    written = spark._jvm.org.apache.hadoop.fs.Path(path)
    written.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(written)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that :func:`write_and_read` wrote; nothing may read it any more."""
    written = spark._jvm.org.apache.hadoop.fs.Path(path)
    written.getFileSystem(spark._jsc.hadoopConfiguration()).delete(written, True)
