"""The registered queries over the test tables; each runs its operator over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import claims, embed, evidence, rank, relate, segment, spans, terms, worldview
from ..session import materialise
from ..sources import corpus, documents
from .extract import Extraction


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str, keep: bool = False) -> Extraction:
    """A run over all documents; ``keep`` where a query reads the same tables several times."""
    return Extraction(documents.from_table(table(spark, sf_dir, "documents")), keep=keep)


def chats(spark: SparkSession, sf_dir: str) -> Extraction:
    """Every conversation as one document, its turns as lines."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return Extraction(documents.from_table(turns.select("conv_id", F.expr("array_join(transform(t, x -> x.text), '\\n')").alias("text")), "conv_id", language_col=None), keep=False)


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("text_hash", F.sha2("text", 256)).drop("text")


def ingest_normalize(spark, sf_dir):
    return docs(spark, sf_dir).ingested.select("document_id", "run_id", "raw_text_hash", F.octet_length("text").cast("long").alias("n_bytes"))


def segment_sentences(spark, sf_dir):
    return _hashed(segment.sentences(docs(spark, sf_dir).ingested)).select("document_id", F.col("pos").cast("long").alias("pos"), "paragraph_index", F.col("start_byte").cast("long").alias("start_byte"), F.col("end_byte").cast("long").alias("end_byte"), "text_hash", F.col("n_words").cast("long").alias("n_words"))


def segment_passages(spark, sf_dir):
    return _hashed(docs(spark, sf_dir).passages)


def canonical_text(spark, sf_dir):
    return claims.with_canonical(table(spark, sf_dir, "conversations")).select("conv_id", "turn", "canonical_text", F.col("n_words").cast("long").alias("n_words"))


def extract_claims(spark, sf_dir):
    return docs(spark, sf_dir).raw_candidates.select("document_id", F.col("pos").cast("long").alias("pos"), F.col("fragment_ids")[0].alias("fragment_id"), "id", "claim_kind", "confidence", "negated", "domain", "assertion_status")


def claim_kind_counts(spark, sf_dir):
    return docs(spark, sf_dir).raw_candidates.groupBy("claim_kind").agg(F.count("*").alias("n"))


def confidence_histogram(spark, sf_dir):
    return docs(spark, sf_dir).raw_candidates.groupBy("confidence").agg(F.count("*").alias("n"))


def domain_counts(spark, sf_dir):
    return docs(spark, sf_dir).raw_candidates.groupBy(F.coalesce("domain", F.lit("none")).alias("domain")).agg(F.count("*").alias("n"))


def negation_counts(spark, sf_dir):
    return chats(spark, sf_dir).raw_candidates.groupBy("negated", "claim_kind").agg(F.count("*").alias("n"))


def claim_roles(spark, sf_dir):
    return docs(spark, sf_dir).roles.select("document_id", F.col("pos").cast("long").alias("pos"), "claim_id", "primary_role")


def terms_heuristic(spark, sf_dir):
    return docs(spark, sf_dir).terms.select("document_id", "id", "text", "normalized_label", "term_type", F.size("passage_ids").cast("long").alias("n_passages"), "confidence")


def embed_hash16(spark, sf_dir):
    return chats(spark, sf_dir).embeddings.select("document_id", F.col("id").alias("passage_id"), F.expr("array_join(transform(vector, v -> cast(cast(round(cast(v as double) * 1000) as bigint) as string)), ' ')").alias("thousandths"))


def cosine_edges(spark, sf_dir):
    return embed.edges(chats(spark, sf_dir).embeddings).withColumn("similarity", F.round("similarity", 6))


def vector_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return embed.nearest(vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), vectors, 10).withColumn("place", F.col("place").cast("long"))


def passage_clusters(spark, sf_dir):
    own = chats(spark, sf_dir).clusters
    return own.select("document_id", F.explode("sequences").alias("sequence"), F.col("sequences")[0].alias("representative"), "confidence")


def argument_links(spark, sf_dir):
    run = chats(spark, sf_dir)
    first = run.clusters.select("document_id", "cluster_no", F.col("sequences")[0].alias("representative"))
    flat = run.arguments.join(first, ["document_id", "cluster_no"]).select("document_id", "representative", F.explode("premise_claim_ids").alias("from_id"), F.col("conclusion_claim_id").alias("to_id"))
    return flat.groupBy("document_id", "representative", "from_id", "to_id").agg(F.count("*").alias("n"))


def dedup_propositions(spark, sf_dir):
    return docs(spark, sf_dir).propositions.select("document_id", F.col("pos").cast("long").alias("pos"), "id", "fingerprint", "claim_kind", "negated", "confidence", F.array_join("fragment_ids", " ").alias("fragment_ids"), F.array_join("duplicate_ids", " ").alias("duplicate_ids"))


def dedup_diagnostics(spark, sf_dir):
    return docs(spark, sf_dir)._normalised[2].select("document_id", "code", "target_id", "message")


def relations_lexical(spark, sf_dir):
    return relate.lexical_relations(docs(spark, sf_dir, True).propositions).select("document_id", "from_id", "to_id", "kind", "confidence")


def relations_variant(spark, sf_dir):
    return relate.variant_relations(docs(spark, sf_dir, True).propositions).select("document_id", "from_id", "to_id", "kind", F.round("confidence", 6).alias("confidence"))


def _scored(spark, sf_dir) -> DataFrame:
    run = docs(spark, sf_dir, True)
    return rank.score(run.propositions, run.passages, run.role_of, run.lexical)


def score_breakdown(spark, sf_dir):
    return _scored(spark, sf_dir).select("document_id", "id", "role", "philosophical_score", "specificity_score", "source_quality_score", "role_score", "relation_score", "final_rank_score", F.col("first_sequence").cast("long").alias("first_sequence"), F.col("first_paragraph").cast("long").alias("first_paragraph"))


def rank_topk(spark, sf_dir):
    return rank.rank(_scored(spark, sf_dir)).filter("pos <= 5").select("document_id", F.col("pos").cast("long").alias("place"), "id", "final_rank_score")


def _norm(spark, sf_dir) -> tuple[Extraction, DataFrame]:
    from ..operators import formal

    run = docs(spark, sf_dir, True)
    return run, formal.normalised_propositions(run.propositions, run.role_of)


def normalized_propositions(spark, sf_dir):
    return _norm(spark, sf_dir)[1].select("document_id", "id", "canonical_text", "claim_kind", "role", "confidence")


def formalizations(spark, sf_dir):
    from ..operators import formal

    return formal.formalise(_norm(spark, sf_dir)[1]).select("document_id", "id", "lean_expression", "ast")


def evaluations(spark, sf_dir):
    from ..operators import formal

    return formal.evaluate(formal.formalise(_norm(spark, sf_dir)[1])).select("document_id", "formalization_id", F.sha2("lean_source", 256).alias("source_hash"))


def worldview_facets(spark, sf_dir):
    return worldview.facets(docs(spark, sf_dir).propositions).select("document_id", "proposition_id", "family", "value", "confidence")


def worldview_relations(spark, sf_dir):
    return worldview.relation_rows(relate.relations(docs(spark, sf_dir, True).propositions)).select("document_id", "id", "kind")


def stage_summaries(spark, sf_dir):
    run = docs(spark, sf_dir, True)
    parts = [("ingest", run.ingested), ("segment", run.passages), ("extract_claims", run.raw_candidates), ("classify_roles", run.roles), ("normalize_propositions", run.propositions), ("relate", relate.relations(run.propositions))]
    out = None
    for name, df in parts:
        one = df.agg(F.count("*").alias("output_count")).select(F.lit(name).alias("name"), "output_count")
        out = one if out is None else out.unionByName(one)
    return out


def claim_labels(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("role", claims.role_of_label("event_type")).groupBy("event_type").agg(F.count("*").alias("n"), F.min("role").alias("role"))


def span_violations(spark, sf_dir):
    """Orders as spans with planted faults, customers as sources."""
    good = F.concat(F.lit("sha256:"), F.sha2(F.lit("text"), 256))
    fault = lambda n, bad, ok: F.when(F.col("o_orderkey") % n == 0, bad).otherwise(ok)
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit("o"), (F.col("o_custkey") + fault(97, F.lit(1000000000), F.lit(0))).cast("string")).alias("source_id"), fault(89, F.lit(1), F.col("o_orderkey")).cast("long").alias("sequence"),
        fault(83, F.lit(" "), F.lit("text")).alias("text"), fault(79, F.lit("md5:0"), good).alias("content_hash"), F.lit("text").alias("locator_kind"), F.lit(0).cast("long").alias("byte_start"), F.lit(4).cast("long").alias("byte_end"), F.lit(None).cast("double").alias("start_seconds"), F.lit(None).cast("double").alias("end_seconds"),
    )
    sources = table(spark, sf_dir, "customer").select(F.concat(F.lit("o"), F.col("c_custkey").cast("string")).alias("id"), F.lit("text").alias("kind"), F.lit("git:1").alias("revision"), good.alias("content_hash"))
    return spans.span_violations(sources, rows).select("code", "message")


def media_interval_join(spark, sf_dir):
    """Clicks of a user that overlap the user's views, each lasting its value in minutes."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("user_id").alias("video_id"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("start_seconds"), "value").withColumn("end_seconds", F.col("start_seconds") + F.col("value") * 60)
    clicks = e.filter("event_type = 'click'").select(F.col("event_id").alias("id"), "video_id", "start_seconds", "end_seconds")
    views = e.filter("event_type = 'view'").select(F.col("event_id").alias("interval_id"), "video_id", "start_seconds", "end_seconds")
    return spans.overlaps(clicks, views).select("span_id", "interval_id")


def source_segments(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    name = F.concat(F.lit("s"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"))
    rows = turns.select(name.alias("id"), F.when(F.col("role") == "user", "timed").otherwise("text").alias("locator_kind"), F.col("turn").cast("double").alias("start_seconds"), F.col("turn").cast("double").alias("end_seconds"), F.lit('{"corpusCoreSegmentRevision":"sha256:0"}').alias("metadata"))
    held = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", name.alias("n")))).alias("t")).select("conv_id", F.col("conv_id").cast("string").alias("document_id"), F.col("conv_id").cast("string").alias("id"), F.expr("transform(t, x -> x.n)").alias("fragment_ids"))
    found = spans.source_segments(held, rows)
    return found.select("conv_id", F.col("source_segments")[0]["segment_id"].alias("first_segment"), F.size("source_segments").cast("long").alias("n_segments"), F.expr("aggregate(transform(filter(source_segments, s -> s.start_seconds is not null), s -> s.start_seconds), cast(null as double), (a, v) -> coalesce(a, 0D) + v)").alias("start_sum"))


def scalar_slice_offsets(spark, sf_dir):
    cut, start, end = corpus.scalar_slice("text", "10", "30")
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(cut).alias("slice"), F.expr(start).cast("long").alias("byte_start"), F.expr(end).cast("long").alias("byte_end"))


def record_revision(spark, sf_dir):
    record = F.to_json(F.struct(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("lang").alias("kind"), F.create_map(F.lit("n_chars"), F.col("n_chars").cast("string")).alias("metadata")))
    return table(spark, sf_dir, "documents").withColumn("record", record).select("doc_id", corpus.revision("source").alias("revision"))


def evidence_records(spark, sf_dir):
    meta = '{"extractionProducer":"loader","extractionProducerVersion":"git:1"}'
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("rep"), F.col("source").alias("scope"), F.concat(F.lit("sha256:"), F.sha2("text", 256)).alias("rep_revision"), F.lit(meta).alias("metadata"))
    made = evidence._record(rows, "metadata", "quill", "scope", "rep", "rep_revision", "extraction", None)
    return made.select("doc_id", "evidence_id", F.sha2("record", 256).alias("record_hash"))


def heading_paths(spark, sf_dir):
    values, bad = corpus.heading_path("v")
    rows = spark.sql("select * from values ('[\"A\", null, \"B\"]'), ('[]'), ('[1]'), ('x'), (null) as t(v)")
    return rows.select(F.coalesce("v", F.lit("none")).alias("v"), F.expr(f"array_join({values}, '/')").alias("path"), F.expr(bad).alias("invalid"))


def relation_rerank(spark, sf_dir):
    # only what relations read is written
    own = materialise(docs(spark, sf_dir).propositions.select("document_id", "pos", "id", "claim_kind", "negated", "fingerprint", "canonical_text", "content_tokens", "relation_tokens"), "propositions")
    return relate.relations(own, True, materialise).select("document_id", "from_id", "to_id", "kind", F.round("confidence", 6).alias("confidence"))


def ner_terms(spark, sf_dir):
    """Terms merged with entities of a stand-in model that takes every lexicon word for a work."""
    run = docs(spark, sf_dir)
    own = run.terms
    entities = own.filter("term_type = 'concept'").select("document_id", F.col("passage_ids")[0].alias("passage_id"), "text", F.col("normalized_label").alias("normalized"), F.lit("work").alias("entity_type"), F.lit(0.9).alias("confidence"))
    return terms.merge_terms(own, terms.entity_terms(entities)).groupBy("term_type", "model_added").agg(F.count("*").alias("n"))


def worldview_json(spark, sf_dir):
    return Extraction(documents.from_table(table(spark, sf_dir, "documents"))).whole().select("document_id", "worldview_id", F.octet_length("worldview").alias("n_bytes"), "worldview")


NAMES = [
    ingest_normalize, segment_sentences, segment_passages, canonical_text, extract_claims, claim_kind_counts, confidence_histogram, domain_counts, negation_counts, claim_roles, terms_heuristic, embed_hash16, cosine_edges, vector_topk,
    passage_clusters, argument_links, dedup_propositions, dedup_diagnostics, relations_lexical, relations_variant, score_breakdown, rank_topk, normalized_propositions, formalizations, evaluations, worldview_facets, worldview_relations,
    stage_summaries, claim_labels, span_violations, media_interval_join, source_segments, scalar_slice_offsets, record_revision, evidence_records, heading_paths, relation_rerank, ner_terms, worldview_json,
]
QUERIES = {f.__name__: f for f in NAMES}
