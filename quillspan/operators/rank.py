"""Scores of claims, their order, and what is recorded about it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import SPARK as S

REASONS = [
    ("philosophical_score >= 0.65", "candidate_ranked_higher_due_to_philosophical_signal"),
    ("philosophical_score <= 0.35", "candidate_ranked_lower_due_to_low_philosophical_score"),
    ("role in ('main_claim', 'conclusion', 'definition')", "candidate_ranked_higher_due_to_argument_role"),
    ("relation_score >= 0.5", "candidate_ranked_higher_due_to_relation_centrality"),
    ("source_quality_score >= 0.8", "candidate_has_source_offsets"),
    ("specificity_score >= 0.8", "candidate_has_clear_predicate"),
    ("has_negation", "candidate_has_negation"),
]
REPORTED = ["candidate_ranked_lower_due_to_low_philosophical_score", "candidate_ranked_higher_due_to_argument_role", "candidate_ranked_higher_due_to_relation_centrality"]


def degrees(relations: DataFrame) -> DataFrame:
    """How many relations end at each claim."""
    return relations.select("document_id", F.explode(F.array("from_id", "to_id")).alias("id")).groupBy("document_id", "id").agg(F.count("*").alias("degree"))


def variants(relations: DataFrame) -> DataFrame:
    """The variants of each claim, in both directions."""
    own = relations.filter("kind = 'variant_of'")
    both = own.select("document_id", F.col("from_id").alias("id"), F.col("to_id").alias("other")).union(own.select("document_id", F.col("to_id").alias("id"), F.col("from_id").alias("other")))
    return both.groupBy("document_id", "id").agg(F.sort_array(F.collect_list("other")).alias("variant_ids"))


def passage_facts(passages: DataFrame) -> DataFrame:
    return passages.select("document_id", F.col("id").alias("fragment_id"), "sequence", "paragraph_index", F.expr(f"end_byte > start_byte and {S.trim('text')} <> ''").alias("placed"), F.expr(S.good_passage("text")).alias("good"))


def score(candidates: DataFrame, passages: DataFrame, roles: DataFrame, relations: DataFrame) -> DataFrame:
    """The index entry of every candidate: seven scores, reasons, first place in the source."""
    spots = candidates.select("document_id", "id", F.explode("fragment_ids").alias("fragment_id")).join(passage_facts(passages), ["document_id", "fragment_id"])
    sources = spots.groupBy("document_id", "id").agg(F.bool_or("placed").alias("placed"), F.bool_or("good").alias("good"), F.min("sequence").alias("first_sequence"), F.min_by("paragraph_index", "sequence").alias("first_paragraph"))
    df = candidates.join(sources, ["document_id", "id"], "left")
    df = df.join(roles.withColumnRenamed("claim_id", "id"), ["document_id", "id"], "left").withColumn("role", F.coalesce("role", F.lit("unknown")))
    df = df.join(degrees(relations), ["document_id", "id"], "left").join(variants(relations), ["document_id", "id"], "left")
    df = df.withColumn("lower", F.expr(S.lower("canonical_text"))).withColumn("n_words", F.expr(S.words("canonical_text")))
    df = df.withColumn("domain", F.expr(f"coalesce(domain, {S.domain('lower')})")).withColumn("has_negation", F.expr(S.negated("lower")))
    df = df.withColumn("philosophical_score", F.expr(S.philosophical_score("lower", "domain", "claim_kind"))).withColumn("specificity_score", F.expr(S.specificity_score("lower", "n_words")))
    df = df.withColumn("source_quality_score", F.expr(f"if(placed is null, 0.2D, {S.clamp('(0.55D + if(placed, 0.25D, 0.0D) + if(good, 0.2D, 0.0D))')})"))
    df = df.withColumn("role_score", F.expr(S.role_score("role"))).withColumn("relation_score", F.expr("least(1.0D, coalesce(degree, 0) * 0.25D)"))
    df = df.withColumn("final_rank_score", F.expr(S.final_score("confidence", "philosophical_score", "specificity_score", "source_quality_score", "role_score", "relation_score")))
    reasons = ", ".join(f"if({condition}, '{name}', null)" for condition, name in REASONS)
    df = df.withColumn("reasons", F.expr(f"filter(array({reasons}, format_string('final_rank_score:%.3f', final_rank_score)), x -> x is not null)"))
    return df.drop("placed", "good", "degree", "lower", "n_words").withColumn("variant_ids", F.coalesce("variant_ids", F.array().cast("array<string>")))


def rank(index: DataFrame) -> DataFrame:
    """Set ``pos`` by final score, confidence, first place in the source, id."""
    order = Window.partitionBy("document_id").orderBy(F.desc("final_rank_score"), F.desc("confidence"), F.asc_nulls_last("first_sequence"), "id")
    return index.withColumn("pos", F.row_number().over(order))


def metadata(index: DataFrame) -> DataFrame:
    """Add ``metadata``: what ranking records about a claim, as JSON with sorted keys."""
    fields = F.struct(
        F.when(F.size("duplicate_ids") > 0, F.col("duplicate_ids")).alias("duplicateSourceIds"), F.col("final_rank_score").alias("finalRankScore"), F.col("fingerprint").alias("normalizedFingerprint"),
        F.col("philosophical_score").alias("philosophicalScore"), F.col("reasons").alias("scoreReasons"), F.col("source_quality_score").alias("sourceQualityScore"), F.col("specificity_score").alias("specificityScore"),
        F.when(F.size("variant_ids") > 0, F.col("variant_ids")).alias("variantOfIds"),
    )
    return index.withColumn("metadata", F.to_json(fields))


def rank_diagnostics(index: DataFrame) -> DataFrame:
    flat = index.select("document_id", "id", F.explode("reasons").alias("code")).filter(F.col("code").isin(REPORTED))
    return flat.select("document_id", "code", F.lit("info").alias("severity"), F.concat("id", F.lit(": ranked for "), "code").alias("message"), F.col("id").alias("target_id"))


def variant_diagnostics(relations: DataFrame) -> DataFrame:
    own = relations.filter("kind = 'variant_of'")
    return own.select("document_id", F.lit("semantic_variant_detected").alias("code"), F.lit("info").alias("severity"), F.concat("from_id", F.lit(" and "), "to_id", F.lit(" may be variants; both stay")).alias("message"), F.col("from_id").alias("target_id"))
