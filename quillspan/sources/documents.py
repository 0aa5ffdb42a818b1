"""Documents from tables, files, strings and request bodies."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config as C

SCHEMA = "id string, kind string, title string, authors array<string>, language string, uri string, text string"
COLUMNS = ("id", "kind", "title", "authors", "language", "uri", "text")


def from_texts(spark: SparkSession, texts: list[str | dict]) -> DataFrame:
    """Documents from strings, or from mappings with any of the document's columns."""
    rows = [{"text": t} if isinstance(t, str) else t for t in texts]
    return spark.createDataFrame([tuple(r.get(c) for c in COLUMNS) for r in rows], SCHEMA)


def plain_text(spark: SparkSession, text: str) -> DataFrame:
    return from_texts(spark, [{"text": text, "kind": "philosophical_text"}])


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """One document per file."""
    null = [F.lit(None).cast("string").alias(c) for c in ("id", "title", "language")]
    return spark.read.text(path, wholetext=True).select(null[0], F.lit("philosophical_text").alias("kind"), null[1], F.lit(None).cast("array<string>").alias("authors"), null[2], F.input_file_name().alias("uri"), F.col("value").alias("text"))


def from_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", language_col: str | None = "lang") -> DataFrame:
    """Documents from a table with one text per row."""
    language = F.col(language_col) if language_col else F.lit(None)
    return df.select(
        F.col(id_col).cast("string").alias("id"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("array<string>").alias("authors"), language.cast("string").alias("language"), F.lit(None).cast("string").alias("uri"), F.col(text_col).alias("text"),
    )


def from_bodies(df: DataFrame, body: str = "body") -> DataFrame:
    """Documents from request bodies: ``{document: {...}}``, else the top-level ``text`` of a JSON object, else the raw text."""
    read = F.from_json(F.col(body), f"document struct<{', '.join(f'{c}: {t}' for c, t in (x.split(' ') for x in SCHEMA.split(', ')))}>, text string")
    parsed = df.withColumn("_p", read)
    is_json = F.expr(f"try_parse_json({body}) is not null and trim({body}) like '{{%'")
    whole = F.col("_p.document.text").isNotNull()
    fields = [F.when(whole, F.col(f"_p.document.{c}")).alias(c) for c in COLUMNS if c != "text"]
    text = F.when(whole, F.col("_p.document.text")).when(is_json, F.col("_p.text")).otherwise(F.col(body)).alias("text")
    return parsed.select(*fields, text)


def handle(path: str, method: str, body: str) -> tuple[int, dict | None]:
    """Routing of the request interface: (status, reply), or (200, None) if an extraction is asked for."""
    if (method, path) == ("GET", "/health"):
        return 200, {"status": "ok"}
    if (method, path) == ("POST", "/extract"):
        return 200, None
    return 404, {"error": "not found"}


def body_config(body: str) -> C.Config:
    """The ``config`` object of a request body; defaults for raw texts."""
    try:
        value = json.loads(body)
    except ValueError:
        return C.from_environment()
    return C.from_json(value.get("config") or {} if isinstance(value, dict) else {})
