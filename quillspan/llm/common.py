"""Shared helpers: table access, bounded Arrow batches."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, ship

#: ASCII white space of the word rule ``[^\x20\x09-\x0D]+``.
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
__all__ = ["materialise"]

#: Bytes in one Arrow batch: what a Python worker holds of whole texts at a time.
ARROW_BYTES = 4 << 20
#: Bytes of input that one file of a result stands for.
FILE_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, size: int = ARROW_BYTES) -> None:
    """Bound Arrow batches by bytes, so that very long texts don't pile up in one; let Python workers find this package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}


def local_rows(spark: SparkSession, rows: list[tuple], columns: dict[str, str]) -> DataFrame:
    """A small driver-side table, handed to the JVM as one Arrow buffer: no Python worker touches it."""

    def kind(t: str) -> pa.DataType:
        return pa.list_(kind(t[6:-1])) if t.startswith("array<") else _ARROW[t]

    data = [pa.array([r[i] for r in rows], kind(t)) for i, t in enumerate(columns.values())]
    return spark.createDataFrame(pa.table(data, names=list(columns)), ", ".join(f"{c} {t}" for c, t in columns.items()))


def partitions(df: DataFrame) -> int:
    """How many files a result gets: as many as the scanned table has partitions, but no more than its size in ``FILE_BYTES`` or the cores."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, min(df.rdd.getNumPartitions(), max(df.sparkSession.sparkContext.defaultParallelism, -(-size // FILE_BYTES))))


def spare(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ascii_lower(col):
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(col, UPPER, LOWER)


def doc_id_as_long(df: DataFrame, id_col: str = "doc_id"):
    return F.col(id_col).cast("long").alias("doc_id")
