"""Merging of claims that say the same: equal fingerprint, kind and polarity within a document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import SPARK as S


def with_tokens(candidates: DataFrame) -> DataFrame:
    """Add ``content_tokens``, ``relation_tokens`` and ``fingerprint``."""
    df = candidates.withColumn("content_tokens", F.expr(S.tokens("canonical_text", R.CONTENT_STOPWORDS))).withColumn("relation_tokens", F.expr(S.tokens("canonical_text", R.RELATION_STOPWORDS)))
    return df.withColumn("fingerprint", F.expr(S.fingerprint("content_tokens")))


def merge(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept candidates, diagnostics). The first of each group is kept and takes over fragments, largest confidence and the others' ids."""
    df = with_tokens(candidates.repartition("document_id"))  # the groups and the order below both keep this partitioning
    key = ["document_id", "fingerprint", "claim_kind", "negated"]
    groups = df.groupBy(*key).agg(
        F.min("pos").alias("pos"), F.min_by(F.struct("id", "canonical_text", "domain", "content_tokens", "relation_tokens"), "pos").alias("first"), F.max("confidence").alias("confidence"), F.count("*").alias("n"),
        F.sort_array(F.collect_list(F.struct("pos", "fragment_ids", "id"))).alias("members"),
    )
    kept = groups.select(
        "document_id", "pos", "first.*", "claim_kind", "negated", "fingerprint", "confidence", F.expr("if(confidence >= 0.55, 'accepted', 'exploring')").alias("assertion_status"),
        F.expr("array_distinct(flatten(transform(members, x -> x.fragment_ids)))").alias("fragment_ids"),
        F.expr("array_sort(array_distinct(transform(slice(members, 2, size(members)), x -> x.id)))").alias("duplicate_ids"), "n", "members",
    )
    merged = kept.select("document_id", F.col("id").alias("kept"), F.explode(F.expr("slice(members, 2, size(members))")).alias("m")).filter("m.id <> kept")  # ids are hashes of texts
    diagnostics = merged.select(
        "document_id", F.lit("fingerprint_duplicate_merged").alias("code"), F.lit("info").alias("severity"),
        F.concat("m.id", F.lit(" says the same as "), "kept").alias("message"), F.col("kept").alias("target_id"),
    )
    return ordered(kept.drop("n", "members")), diagnostics


def ordered(candidates: DataFrame) -> DataFrame:
    """Set ``pos`` by first fragment id (as text), then id."""
    order = Window.partitionBy("document_id").orderBy(F.expr("get(fragment_ids, 0)").asc_nulls_first(), "id")
    return candidates.withColumn("pos", F.row_number().over(order))
