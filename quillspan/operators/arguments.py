"""Arguments: the claims of a passage cluster, one of them the conclusion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconstruct(clusters: DataFrame, claims: DataFrame, roles: DataFrame) -> DataFrame:
    """id, cluster_id, premise_claim_ids, conclusion_claim_id, confidence per cluster of two claims or more."""
    members = clusters.select("document_id", "cluster_no", "cluster_id", F.explode("passage_ids").alias("passage_id"))
    spots = claims.select("document_id", "pos", F.col("id").alias("claim_id"), F.explode("fragment_ids").alias("passage_id"))
    held = spots.join(members, ["document_id", "passage_id"]).select("document_id", "cluster_no", "cluster_id", "pos", "claim_id").distinct()
    held = held.join(roles, ["document_id", "claim_id"], "left").withColumn("leads", F.col("role").isin("conclusion", "main_claim"))
    groups = held.groupBy("document_id", "cluster_no", "cluster_id").agg(
        F.count("*").alias("n"), F.coalesce(F.min_by("claim_id", F.when(F.col("leads"), F.col("pos"))), F.max_by("claim_id", "pos")).alias("conclusion_claim_id"),
        F.sort_array(F.collect_list(F.struct("pos", "claim_id"))).alias("all"),
    )
    found = groups.filter("n >= 2").withColumn("premise_claim_ids", F.expr("transform(filter(all, x -> x.claim_id <> conclusion_claim_id), x -> x.claim_id)")).filter("size(premise_claim_ids) > 0")
    return found.select("document_id", "cluster_no", F.concat(F.lit("arg_"), F.substring(F.sha2(F.concat("cluster_id", "conclusion_claim_id"), 256), 1, 16)).alias("id"), "cluster_id", "premise_claim_ids", "conclusion_claim_id", F.lit(0.58).alias("confidence"))
