"""Formal stubs of propositions: expression trees, Lean expressions and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPARK as S


def normalised_propositions(candidates: DataFrame, roles: DataFrame) -> DataFrame:
    """Candidates by text: claim ids and passages in order, largest confidence, the first one's role."""
    df = candidates.join(roles.withColumnRenamed("claim_id", "id"), ["document_id", "id"], "left") if "role" not in candidates.columns else candidates
    groups = df.groupBy("document_id", "canonical_text").agg(F.min_by(F.struct("id", "claim_kind", "role"), "pos").alias("first"), F.sort_array(F.collect_list(F.struct("pos", "id", "fragment_ids"))).alias("all"), F.max("confidence").alias("confidence"))
    return groups.select(
        "document_id", "first.id", "canonical_text", F.expr("transform(all, x -> x.id)").alias("claim_ids"), F.expr("array_distinct(flatten(transform(all, x -> x.fragment_ids)))").alias("passage_ids"),
        "first.claim_kind", F.coalesce("first.role", F.lit("unknown")).alias("role"), "confidence",
    )


def formalise(propositions: DataFrame) -> DataFrame:
    df = propositions.withColumn("predicate", F.expr(S.identifier("id"))).withColumn("_not", F.expr(f"contains({S.lower('canonical_text')}, ' not ')"))
    atom = "concat('{\"args\":[],\"kind\":\"atomic\",\"predicate\":\"', predicate, '\"}')"
    return df.select(
        "document_id", F.concat(F.lit("formal_"), "id").alias("id"), F.col("id").alias("proposition_id"), F.expr(f"if(_not, concat('{{\"kind\":\"not\",\"value\":', {atom}, '}}'), {atom})").alias("ast"),
        F.expr("if(_not, 'Not (True)', 'True')").alias("lean_expression"), F.lit("schema_valid").alias("status"), F.lit(0.5).alias("confidence"),
    )


def evaluate(formalisations: DataFrame, lean_bin: str = "lean") -> DataFrame:
    name = S.identifier("id")
    source = F.concat(F.lit(f"-- Lean binary: {lean_bin}\ndef "), F.expr(name), F.lit(" : Prop := "), "lean_expression", F.lit("\n#check "), F.expr(name), F.lit("\n"))
    return formalisations.select("document_id", F.col("id").alias("formalization_id"), "proposition_id", F.lit("unsupported").alias("status"), source.alias("lean_source"), F.lit("unsupported_goal").alias("diagnostic"))


def lean(tree: dict) -> str:
    """The Lean expression of an expression tree; trees nest to any depth, so this is for single trees on the driver."""
    kind = tree["kind"]
    if kind == "atomic":
        return "True"
    if kind == "not":
        return f"Not ({lean(tree['value'])})"
    if kind in ("and", "or"):
        return (" /\\ " if kind == "and" else " \\/ ").join(map(lean, tree["values"]))
    if kind == "implies":
        return f"({lean(tree['left'])}) -> ({lean(tree['right'])})"
    if kind == "iff":
        return f"Iff ({lean(tree['left'])}) ({lean(tree['right'])})"
    if kind in ("for_all", "exists"):
        return f"{'forall' if kind == 'for_all' else 'exists'} {tree['variable']} : Prop, {lean(tree['body'])}"
    raise ValueError(f"unknown kind of expression {kind!r}")
