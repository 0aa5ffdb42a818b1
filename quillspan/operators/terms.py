"""Terms: capitalised words and a small lexicon, and their merger with a model's entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import SPARK as S

#: The term type of each kind of entity.
ENTITY_TYPES = {
    "person": "person", "work": "work", "law": "work", "organization": "school", "misc": "technical_term", "product": "technical_term", "event": "technical_term", "location": "place", "date": "other", "amount": "other",
}


def term_id(col: str) -> Column:
    return F.concat(F.lit("term_"), F.substring(F.sha2(col, 256), 1, 16))


def heuristic_terms(passages: DataFrame) -> DataFrame:
    """One row per document and label: first spelling, passages in order, type, confidence."""
    words = passages.select("document_id", F.col("id").alias("passage_id"), "sequence", F.posexplode(F.expr(S.split("text", r"[^\p{IsAlphabetic}\p{N}']+"))).alias("n", "word"))
    words = words.filter("octet_length(word) > 2").withColumn("normalized_label", F.expr(S.lower(S.replace("word", r"^[^\p{IsAlphabetic}\p{N}]+|[^\p{IsAlphabetic}\p{N}]+$")))).filter("normalized_label <> ''")
    lexicon = F.col("normalized_label").isin(R.LEXICON)
    words = words.filter(lexicon | F.expr(S.matches("word", r"^\p{Lu}")))
    first = words.groupBy("document_id", "normalized_label", "passage_id").agg(F.min("sequence").alias("sequence"), F.min(F.struct("sequence", "n", "word")).alias("first"))
    found = first.groupBy("document_id", "normalized_label").agg(F.min("first").alias("first"), F.sort_array(F.collect_list(F.struct("sequence", "passage_id"))).alias("seen"))
    return found.select(
        "document_id", term_id("normalized_label").alias("id"), F.col("first.word").alias("text"), "normalized_label", F.when(lexicon, "concept").otherwise("other").alias("term_type"),
        F.expr("transform(seen, x -> x.passage_id)").alias("passage_ids"), F.when(lexicon, 0.78).otherwise(0.52).alias("confidence"), (~lexicon).alias("requires_review"), F.lit(False).alias("model_added"),
    )


def entity_terms(entities: DataFrame) -> DataFrame:
    """Terms from a model's entities (document_id, passage_id, text, normalized, entity_type, confidence)."""
    label = F.expr(f"if({S.trim('coalesce(normalized, chr(0))')} in ('', chr(0)), {S.lower('text')}, {S.lower('normalized')})")
    kinds = F.create_map(*[F.lit(x) for kv in ENTITY_TYPES.items() for x in kv])
    df = entities.withColumn("normalized_label", label)
    return df.select(
        "document_id", term_id("normalized_label").alias("id"), "text", "normalized_label", F.coalesce(kinds[F.lower("entity_type")], F.lit("other")).alias("term_type"),
        F.array("passage_id").alias("passage_ids"), F.col("confidence").cast("double").alias("confidence"), F.lit(True).alias("requires_review"), F.lit(True).alias("model_added"),
    )


def merge_terms(heuristic: DataFrame, model: DataFrame) -> DataFrame:
    """Terms of both kinds by label: passages in order, largest confidence, the first type that is not ``other``."""
    both = heuristic.withColumn("_n", F.lit(0)).unionByName(model.withColumn("_n", F.lit(1)))
    found = both.groupBy("document_id", "normalized_label").agg(
        F.min_by("id", "_n").alias("id"), F.min_by("text", "_n").alias("text"), F.coalesce(F.min_by("term_type", F.when(F.col("term_type") != "other", F.col("_n"))), F.lit("other")).alias("term_type"),
        F.sort_array(F.collect_list(F.struct("_n", "passage_ids"))).alias("seen"), F.max("confidence").alias("confidence"), F.min_by("requires_review", "_n").alias("requires_review"), F.bool_or("model_added").alias("model_added"),
    )
    return found.withColumn("passage_ids", F.expr("array_distinct(flatten(transform(seen, x -> x.passage_ids)))")).drop("seen")


def ner_unavailable(documents: DataFrame, error: str) -> DataFrame:
    """The diagnostic that stands in for a missing entity model."""
    return documents.select("document_id", F.lit("ner_provider_unavailable").alias("code"), F.lit("warning").alias("severity"), F.lit(f"The entity model was unavailable; heuristic terms were used: {error}").alias("message"), F.lit(None).cast("string").alias("target_id"))
