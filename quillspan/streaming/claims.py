"""Claims from a stream of documents: ingestion, sentences and claim rules need no state, so every micro-batch stands alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPARK as S
from ..operators import claims, segment


def stream_claims(documents: DataFrame) -> DataFrame:
    """Claims of every sentence of a stream of documents (as from :mod:`quillspan.sources.documents`), without merging short sentences."""
    docs = segment.ingest(documents)
    cut = docs.select("document_id", F.posexplode(F.expr(segment.pieces(S, "text"))).alias("pos", "piece"))
    fragments = cut.select("document_id", "pos", F.concat(F.lit("sentence_"), "document_id", F.lit("_"), F.col("pos").cast("string")).alias("id"), F.expr(S.trim("piece")).alias("text")).filter("text <> ''")
    return claims.extract(fragments)


def write_claims(documents: DataFrame, path: str, checkpoint: str):
    """Append the stream's claims to a Parquet table, exactly once per micro-batch."""
    return stream_claims(documents).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
