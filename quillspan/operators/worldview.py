"""The nested export: propositions with assertions and facets, relations, sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRODUCER = "quillspan"


def facets(candidates: DataFrame) -> DataFrame:
    """document_id, pos, proposition_id, family, value, provenance, confidence."""
    kind = F.struct(F.lit("claim_kind").alias("family"), F.col("claim_kind").alias("value"))
    domain = F.when(F.col("domain").isNotNull(), F.struct(F.lit("philosophical_domain").alias("family"), F.col("domain").alias("value")))
    flat = candidates.select("document_id", "pos", "id", "confidence", F.explode(F.expr("filter(_f, x -> x is not null)")).alias("f")) if "_f" in candidates.columns else candidates.withColumn("_f", F.array(kind, domain)).select("document_id", "pos", "id", "confidence", F.explode(F.filter("_f", lambda x: x.isNotNull())).alias("f"))
    return flat.select("document_id", "pos", F.col("id").alias("proposition_id"), "f.family", "f.value", F.lit("heuristic").alias("provenance"), "confidence")


def relation_rows(relations: DataFrame) -> DataFrame:
    long = F.concat(F.lit("relation_"), "from_id", F.lit("_"), "kind", F.lit("_"), "to_id")
    own = F.when(F.octet_length(long) <= 120, long).otherwise(F.concat(F.lit("relation_"), F.substring(F.sha2(long, 256), 1, 32)))
    return relations.select("document_id", own.alias("id"), "from_id", "to_id", "kind", "note")


def assertion() -> F.Column:
    return F.struct(F.concat(F.lit("assertion_"), "id").alias("id"), F.col("assertion_status").alias("status"), F.lit("generated").alias("provenance"), "confidence", F.col("fragment_ids").alias("sourceFragmentIds"))


def build(docs: DataFrame, fragments: DataFrame, candidates: DataFrame, relations: DataFrame, worldview_id: str | None = None, label: str | None = None, pretty: bool = False) -> DataFrame:
    """document_id, worldview_id and the JSON text of every document's worldview."""
    facet = F.array(
        F.struct(F.lit("claim_kind").alias("family"), F.col("claim_kind").alias("value"), F.lit("heuristic").alias("provenance"), "confidence"),
        F.when(F.col("domain").isNotNull(), F.struct(F.lit("philosophical_domain").alias("family"), F.col("domain").alias("value"), F.lit("heuristic").alias("provenance"), "confidence")),
    )
    meta = F.struct(
        F.col("claim_kind").alias("claimKind"), "confidence", "domain", F.when(F.size("duplicate_ids") > 0, F.col("duplicate_ids")).alias("duplicateSourceIds"), F.lit("heuristic-v1").alias("extractor"), F.col("final_rank_score").alias("finalRankScore"),
        F.lit(PRODUCER).alias("generatedBy"), "negated", F.col("fingerprint").alias("normalizedFingerprint"), F.col("philosophical_score").alias("philosophicalScore"), F.lit(PRODUCER).alias("provider"), F.lit(True).alias("reviewRequired"),
        F.col("reasons").alias("scoreReasons"), F.col("source_quality_score").alias("sourceQualityScore"), F.col("specificity_score").alias("specificityScore"), F.when(F.size("variant_ids") > 0, F.col("variant_ids")).alias("variantOfIds"),
    )
    proposition = F.struct("id", F.col("canonical_text").alias("canonicalText"), F.array(assertion()).alias("assertions"), F.col("fragment_ids").alias("sourceFragmentIds"), F.filter(facet, lambda x: x.isNotNull()).alias("facets"), meta.alias("metadata"))
    props = candidates.groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct("pos", proposition.alias("p")))).alias("props"))
    own = relation_rows(relations)
    rels = own.groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct("from_id", "to_id", "kind", F.struct("id", F.col("from_id").alias("fromPropositionId"), F.col("to_id").alias("toPropositionId"), "kind", "note").alias("r")))).alias("rels"))
    frags = fragments.groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct("pos", F.struct("id", F.col("document_id").alias("documentId"), "locator", "text").alias("f")))).alias("frags"))
    df = docs.join(props, "document_id", "left").join(rels, "document_id", "left").join(frags, "document_id", "left")
    given = F.lit(worldview_id) if worldview_id and worldview_id.strip() else F.concat(F.lit("draft-worldview-"), F.substring("raw_text_hash", 1, 16))
    value = F.struct(
        F.lit("10").alias("schemaVersion"), given.alias("id"), F.lit("unified_worldview_v2").alias("fragment"), F.coalesce(F.lit(label), "title", F.lit("Draft philosophical worldview")).alias("label"),
        F.expr("coalesce(transform(props, x -> x.p), array())").alias("propositions"), F.expr("coalesce(transform(rels, x -> x.r), array())").alias("relations"),
        F.array(F.struct(F.col("document_id").alias("id"), "kind", "title", F.when(F.size("authors") > 0, F.col("authors")).alias("authors"), "language", "uri")).alias("sourceDocuments"),
        F.expr("coalesce(transform(frags, x -> x.f), array())").alias("sourceFragments"),
        F.struct(F.lit(PRODUCER).alias("generatedBy"), F.lit(PRODUCER).alias("provider"), F.lit(True).alias("reviewRequired"), F.lit("text_extraction").alias("source"), F.lit("unified worldview v10").alias("targetContract")).alias("metadata"),
    )
    return df.select("document_id", given.alias("worldview_id"), F.to_json(value, {"pretty": str(pretty).lower()}).alias("worldview"))
