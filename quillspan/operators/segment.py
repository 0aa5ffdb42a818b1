"""Ingestion of texts and their segmentation into passages with byte offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.columns import once
from ..functions.text import SPARK as S

#: Marks between pieces and behind abbreviations, and the mark that escapes both where a text itself holds them.
CUT, ESCAPE = "\ue000", "\ue001"
ESCAPED_ESCAPE, ESCAPED_CUT, GUARD = ESCAPE + "\ue002", ESCAPE + "\ue003", ESCAPE + "\ue004"
CLOSERS = "[\"')\\]”’»]*"


def guard_pattern() -> str:
    return rf"\b({'|'.join(R.ABBREVIATIONS)})\.({R.WHITE})"


def cut_pattern() -> str:
    return rf"([.!?]+{CLOSERS})({R.WHITE}+)"


def pieces(d, text: str) -> str:
    """SQL: the pieces of a text; put together they are the text. A cut stands behind closing marks before white space, but not behind abbreviations."""
    put = lambda x, *pairs: put(f"replace({x}, {d.text(pairs[0][0])}, {d.text(pairs[0][1])})", *pairs[1:]) if pairs else x
    escaped = put(text, (ESCAPE, ESCAPED_ESCAPE), (CUT, ESCAPED_CUT))
    guarded = d.replace(escaped, guard_pattern(), f"\\1.{GUARD}\\2")
    cut = d.replace(guarded, cut_pattern(), f"\\1{CUT}\\2")
    return d.map(d.split(cut, CUT), "p", put("p", (GUARD, ""), (ESCAPED_CUT, CUT), (ESCAPED_ESCAPE, ESCAPE)))


def ingest(docs: DataFrame) -> DataFrame:
    """Documents with normalised text, ``document_id``, ``run_id`` (of the raw text) and ``raw_text_hash`` (of the normalised one); empty ones are dropped.

    Use :func:`empty_inputs` to see which were dropped.
    """
    df = once(docs.withColumn("raw", F.coalesce("text", F.lit(""))), text=S.ingest("text")).filter("text <> ''")
    df = df.withColumn("kind", F.expr("coalesce(nullif(kind, ''), 'philosophical_text')"))
    df = df.withColumn("raw_text_hash", F.sha2("text", 256))
    own = F.expr(f"nullif({S.trim('id')}, '')")
    df = df.withColumn("document_id", F.coalesce(own, F.concat(F.lit("doc_"), F.substring("raw_text_hash", 1, 16))))
    return df.withColumn("run_id", F.concat(F.lit("run_"), F.substring(F.sha2("raw", 256), 1, 16))).drop("raw")


def empty_inputs(docs: DataFrame) -> DataFrame:
    """The documents that :func:`ingest` rejects, with the error's name."""
    return docs.filter(F.expr(f"{S.ingest('text')} = ''")).withColumn("error", F.lit("empty_input"))


def sentences(docs: DataFrame) -> DataFrame:
    """document_id, pos, paragraph_index, start_byte, end_byte, text, n_words of every sentence of ingested documents."""
    cut = docs.select("document_id", F.posexplode(F.expr(pieces(S, "text"))).alias("pos", "piece"))
    breaks = lambda x: f"if(contains({x}, '\\n'), size(split({x}, '\\\\n[ \\\\t]*\\\\n')) - 1, 0)"
    stripped = S.left_trim("piece")
    cut = once(cut, text=S.trim("piece"), lead=f"octet_length(piece) - octet_length({stripped})", breaks=breaks("piece"), lead_breaks=breaks(f"left(piece, char_length(piece) - char_length({stripped}))"))
    before = Window.partitionBy("document_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("base", F.coalesce(F.sum(F.octet_length("piece")).over(before), F.lit(0))).withColumn("paragraph_index", F.coalesce(F.sum("breaks").over(before), F.lit(0)) + F.col("lead_breaks"))
    placed = placed.filter("text <> ''").withColumn("start_byte", F.col("base") + F.col("lead")).withColumn("n_words", F.expr(S.words("text")))
    return placed.select("document_id", "pos", F.col("paragraph_index").cast("long").alias("paragraph_index"), "start_byte", (F.col("start_byte") + F.octet_length("text")).alias("end_byte"), "text", "n_words")


def merge_tiny(spans: DataFrame) -> DataFrame:
    """Sentences of under three words join their neighbour in the paragraph.

    A group begins at a paragraph's first sentence, or at a sentence of three words or more once the paragraph has three.
    """
    paragraph = Window.partitionBy("document_id", "paragraph_index").orderBy("pos")
    by_doc = Window.partitionBy("document_id").orderBy("pos")
    df = spans.withColumn("sentence", F.row_number().over(paragraph))
    held = F.coalesce(F.sum("n_words").over(paragraph.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    df = df.withColumn("fresh", F.when((F.col("sentence") == 1) | ((F.col("n_words") >= 3) & (held >= 3)), 1).otherwise(0))
    df = df.withColumn("sequence", F.sum("fresh").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    parts = df.groupBy("document_id", "sequence").agg(
        F.min("paragraph_index").alias("paragraph_index"), F.min_by("sentence", "pos").alias("sentence"), F.min("start_byte").alias("start_byte"), F.max("end_byte").alias("end_byte"),
        F.sort_array(F.collect_list(F.struct("pos", "text"))).alias("parts"),
    )
    return parts.withColumn("text", F.expr("array_join(transform(parts, x -> x.text), ' ')")).drop("parts")


def passages(docs: DataFrame) -> DataFrame:
    """id, document_id, paragraph_index, sequence, locator, start_byte, end_byte, text of every passage of ingested documents."""
    df = merge_tiny(sentences(docs))
    return df.select(
        F.concat(F.lit("frag_"), "document_id", F.lit("_"), F.col("sequence").cast("string")).alias("id"), "document_id", "paragraph_index", "sequence",
        F.concat(F.lit("paragraph "), (F.col("paragraph_index") + 1).cast("string"), F.lit(", sentence "), F.col("sentence").cast("string")).alias("locator"),
        "start_byte", "end_byte", "text",
    )


def fragments(rows: DataFrame) -> DataFrame:
    """Source fragments of passages."""
    return rows.select("id", "document_id", "locator", "text", F.col("sequence").alias("pos"))
