"""Relations between a document's claims: set similarity of their tokens by an equi-join on tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..session import materialise
from . import embed

RELATION = "document_id string, from_id string, to_id string, kind string, confidence double, note string, metadata string"
NOTES = {
    "contradicts": "Common words, one claim denies.", "generalizes": "One claim speaks of all cases, the other of some.",
    "supports": "A condition with common words: one may back the other.", "variant_of": "Nearly the same words; to be reviewed.",
    "argument": "Premise and conclusion of one argument.",
}


def pairs(candidates: DataFrame, tokens: str, least: float, write: Callable[[DataFrame, str], DataFrame] = materialise) -> DataFrame:
    """Pairs with Jaccard similarity of at least ``least`` (> 0), left before right by ``pos``; pairs without a common token never meet.

    Pairs meet and are counted by number alone, and only where the sizes of their sets allow the similarity; other columns join what remains.
    """
    own = candidates.select("document_id", "pos", F.size(tokens).alias("n"), F.explode(tokens).alias("token"))
    left, right = (own.select("document_id", "token", F.col("pos").alias(f"pos_{s}"), F.col("n").alias(f"n_{s}")) for s in "lr")
    met = left.join(right, ["document_id", "token"]).filter(f"pos_l < pos_r and least(n_l, n_r) >= {least} * greatest(n_l, n_r) - 1e-9")
    counted = met.groupBy("document_id", "pos_l", "pos_r", "n_l", "n_r").agg(F.count("*").alias("common"))
    near = counted.withColumn("overlap", F.expr("common / (n_l + n_r - common)")).filter(F.col("overlap") >= least)
    near = write(near, "near")  # few rows: written before other columns join, so that these are not shuffled beside the tokens
    left, right = (candidates.select("document_id", *(F.col(c).alias(f"{c}_{s}") for c in ("pos", "id", "claim_kind", "negated", "fingerprint"))) for s in "lr")
    return near.join(left, ["document_id", "pos_l"]).join(right, ["document_id", "pos_r"])


def lexical_relations(candidates: DataFrame, write: Callable[[DataFrame, str], DataFrame] = materialise) -> DataFrame:
    """contradicts, generalizes and supports, from shared vocabulary."""
    found = pairs(candidates, "relation_tokens", R.RELATED, write)
    kind = F.expr(f"""case when negated_l <> negated_r and overlap >= {R.OPPOSED} then 'contradicts' when (claim_kind_l = 'universal') <> (claim_kind_r = 'universal') then 'generalizes'
        when claim_kind_l = 'conditional' or claim_kind_r = 'conditional' then 'supports' end""")
    found = found.withColumn("kind", kind).filter("kind is not null").withColumn("turned", F.expr("kind = 'generalizes' and claim_kind_r = 'universal'"))
    confidence = F.expr("case kind when 'contradicts' then 0.72D when 'generalizes' then 0.68D else 0.66D end")
    note = F.create_map(*[F.lit(x) for k in ("contradicts", "generalizes", "supports") for x in (k, NOTES[k])])[F.col("kind")]
    return found.select(
        "document_id", F.expr("if(turned, id_r, id_l)").alias("from_id"), F.expr("if(turned, id_l, id_r)").alias("to_id"), "kind", confidence.alias("confidence"), note.alias("note"),
        F.lit('{"generatedBy":"heuristic-relation-inference","reviewRequired":true}').alias("metadata"),
    )


def variant_relations(candidates: DataFrame, write: Callable[[DataFrame, str], DataFrame] = materialise) -> DataFrame:
    """variant_of: same polarity, compatible kinds, different fingerprints, very similar words."""
    found = pairs(candidates, "content_tokens", R.VARIANT, write)
    found = found.filter("id_l <> id_r and negated_l = negated_r and fingerprint_l <> fingerprint_r and (claim_kind_l = claim_kind_r or claim_kind_l = 'atomic' or claim_kind_r = 'atomic')")
    metadata = F.concat(F.lit('{"generatedBy":"candidate-quality-ranker","reviewRequired":true,"similarityKind":"lexical","similarityScore":'), F.col("overlap").cast("string"), F.lit("}"))
    return found.select("document_id", F.col("id_l").alias("from_id"), F.col("id_r").alias("to_id"), F.lit("variant_of").alias("kind"), F.col("overlap").alias("confidence"), F.lit(NOTES["variant_of"]).alias("note"), metadata.alias("metadata"))


def relations(candidates: DataFrame, rerank: bool = False, share: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Both kinds of relations; ``share`` may write each before the next is looked for, so that their shuffles don't add up, and writes near pairs."""
    write, keep = share or materialise, share or (lambda df, name: df)
    found = keep(lexical_relations(candidates, write), "vocabulary").unionByName(keep(variant_relations(candidates, write), "variants"))
    return reranked(candidates, found) if rerank else found


def reranked(candidates: DataFrame, found: DataFrame, k: int = 8) -> DataFrame:
    """Confidence raised to a hybrid retrieval score (three parts cosine of hashed vectors, one part Jaccard) where the target is among the source's k best.

    Sources are compared with all claims of their documents; documents without relations have no source, so their claims get no vectors.
    """
    found = materialise(found, "found-relations")
    held = candidates.select("document_id", "id", "canonical_text", "content_tokens").join(found.select("document_id").distinct(), "document_id", "left_semi")
    own = embed.hash_embedding(held, embed.RETRIEVAL_DIMENSIONS, "canonical_text", decimals=False).withColumn("n", embed.norm("vector"))
    queries = found.select("document_id", F.col("from_id").alias("id")).distinct().join(own, ["document_id", "id"])
    left = queries.select("document_id", F.col("id").alias("from_id"), F.col("vector").alias("v_l"), F.col("n").alias("n_l"), F.col("content_tokens").alias("t_l"))
    right = own.select("document_id", F.col("id").alias("to_id"), F.col("vector").alias("v_r"), F.col("n").alias("n_r"), F.col("content_tokens").alias("t_r"))
    scored = left.join(right, "document_id").withColumn("semantic", embed.cosine("v_l", "v_r", "n_l", "n_r"))
    scored = scored.withColumn("lexical", F.expr("if(size(t_l) = 0 or size(t_r) = 0, 0.0D, size(array_intersect(t_l, t_r)) / size(array_union(t_l, t_r)))")).withColumn("score", F.expr("least(1.0D, greatest(0.0D, 0.75D * semantic + 0.25D * lexical))"))
    best = scored.withColumn("place", F.row_number().over(Window.partitionBy("document_id", "from_id").orderBy(F.desc("score"), "to_id"))).filter(F.col("place") <= k)
    joined = found.join(best.select("document_id", "from_id", "to_id", "semantic", "lexical", "score"), ["document_id", "from_id", "to_id"], "left")
    extra = F.concat(F.expr("substr(metadata, 1, char_length(metadata) - 1)"), F.lit(',"rankingBackend":"text-retrieval-hybrid","semanticScore":'), F.col("semantic").cast("string"), F.lit(',"lexicalScore":'), F.col("lexical").cast("string"), F.lit("}"))
    return joined.select("document_id", "from_id", "to_id", "kind", F.greatest("confidence", F.coalesce("score", "confidence")).alias("confidence"), "note", F.when(F.col("score").isNull(), F.col("metadata")).otherwise(extra).alias("metadata"))


def argument_relations(arguments: DataFrame) -> DataFrame:
    """One supports relation per premise of every argument."""
    flat = arguments.select("document_id", "id", "conclusion_claim_id", F.explode("premise_claim_ids").alias("premise"))
    return flat.select(
        "document_id", F.col("premise").alias("from_id"), F.col("conclusion_claim_id").alias("to_id"), F.lit("supports").alias("kind"), F.lit(0.6).alias("confidence"), F.lit(NOTES["argument"]).alias("note"),
        F.concat(F.lit('{"argumentId":"'), "id", F.lit('","reviewRequired":true}')).alias("metadata"),
    )
