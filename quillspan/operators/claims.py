"""Claims from fragments, their normalisation, and their roles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.columns import once
from ..functions.text import SPARK as S

EXTRACTOR = "heuristic-v1"


def with_canonical(df: DataFrame, source: str = "text") -> DataFrame:
    """Add ``canonical_text``, ``lower`` and ``n_words`` of a text column."""
    bare = df.withColumn("_bare", F.expr(S.canonical(source)))
    done = once(bare, canonical_text=S.canonical_done("_bare")).drop("_bare")
    return once(done, lower=S.lower("canonical_text"), n_words=S.words("canonical_text"))


def proposition_id(col: str = "canonical_text") -> Column:
    return F.concat(F.lit("p_"), F.substring(F.sha2(col, 256), 1, 24))


def extract(fragments: DataFrame) -> DataFrame:
    """Candidates from fragments (id, document_id, text, pos): statements of three words or more that are neither questions nor instructions."""
    df = with_canonical(fragments.select("document_id", "pos", F.col("id").alias("fragment_id"), "text"))
    df = df.filter("canonical_text <> '' and n_words >= 3").filter(f"not {S.is_question('canonical_text', 'lower')} and not {S.is_instruction('lower')}")
    df = once(df, claim_kind=S.claim_kind("lower"))
    df = once(df, confidence=S.confidence("canonical_text", "lower", "n_words", "claim_kind"), negated=S.negated("lower"), domain=S.domain("lower"))
    return df.select(
        "document_id", "pos", proposition_id().alias("id"), "canonical_text", "claim_kind", F.expr("if(confidence >= 0.55, 'accepted', 'exploring')").alias("assertion_status"), "confidence",
        "negated", "domain", F.array("fragment_id").alias("fragment_ids"), F.lit(EXTRACTOR).alias("extractor"),
    )


def claim_candidates(candidates: DataFrame, passages: DataFrame) -> DataFrame:
    """Candidates with the byte offsets of their passages; those without a known passage are dropped."""
    spots = candidates.select("document_id", "pos", F.posexplode("fragment_ids").alias("n", "passage_id"))
    known = spots.join(passages.select("document_id", F.col("id").alias("passage_id"), "start_byte", "end_byte"), ["document_id", "passage_id"])
    offsets = known.groupBy("document_id", "pos").agg(F.sort_array(F.collect_list(F.struct("n", "passage_id", "start_byte", "end_byte"))).alias("found"))
    offsets = offsets.select("document_id", "pos", F.expr("transform(found, x -> struct(x.passage_id, x.start_byte, x.end_byte))").alias("source_offsets"))
    return candidates.join(offsets, ["document_id", "pos"]).withColumn("requires_review", F.lit(True))


def roles(claims: DataFrame, classifier: bool = False) -> DataFrame:
    """document_id, pos, claim_id, primary_role: from kind, place and number of claims; ``classifier`` lets cue words decide first."""
    by_doc = Window.partitionBy("document_id")
    df = claims.withColumn("_last", F.row_number().over(by_doc.orderBy(F.desc("pos"))) == 1).withColumn("_n", F.count("*").over(by_doc))
    role = F.expr("""case when claim_kind = 'definition' then 'definition' when claim_kind = 'conditional' then if(_last, 'conclusion', 'premise') when claim_kind = 'normative' then 'main_claim'
        when claim_kind = 'unknown' then 'unknown' when _last and _n > 1 then 'conclusion' else 'premise' end""")
    if classifier:
        role = classified_role("canonical_text")
    return df.select("document_id", "pos", F.col("id").alias("claim_id"), role.alias("primary_role"), F.lit(0.64).alias("confidence"))


def classified_role(col: str) -> Column:
    lower = S.lower(col)
    return F.expr(f"case when {S.any_of(lower, ['because', 'therefore'])} then 'conclusion' when {S.any_of(lower, ['for example'])} then 'example' else 'premise' end")


def classified_kind(col: str) -> Column:
    lower = S.lower(col)
    return F.expr(f"case when contains({lower}, ' if ') or startswith({lower}, 'if ') then 'conditional' when {S.any_of(lower, [' should ', ' ought '])} then 'normative' when {S.any_of(lower, [' is ', ' are '])} then 'atomic' else 'unknown' end")


def classified_relation(left: str, right: str) -> Column:
    return F.expr(f"if(contains({left}, ' not ') <> contains({right}, ' not '), 'contradicts', 'supports')")


def last_roles(found: DataFrame) -> DataFrame:
    """One role per claim id: the last one, as ids may repeat before duplicates are merged."""
    return found.groupBy("document_id", "claim_id").agg(F.max_by("primary_role", "pos").alias("role"))


#: Labels that parsers know, besides those spelled like the value itself.
KINDS = ["atomic", "conditional", "definition", "modal", "normative", "universal"]
ROLES = ["main_claim", "premise", "conclusion", "definition", "objection", "reply", "example", "background", "qualification"]
RELATIONS = ["supports", "contradicts", "generalizes", "specializes", "variant_of"]


def label(col: str) -> str:
    return f"translate({S.lower(S.trim(col))}, '- ', '__')"


def kind_of_label(col: str) -> Column:
    return F.expr(f"case when {label(col)} in ({', '.join(map(S.text, KINDS))}) then {label(col)} else 'unknown' end")


def role_of_label(col: str) -> Column:
    return F.expr(f"case when {label(col)} = 'mainclaim' then 'main_claim' when {label(col)} in ({', '.join(map(S.text, ROLES))}) then {label(col)} else 'unknown' end")


def relation_of_label(col: str) -> Column:
    return F.expr(f"case when {label(col)} = 'variantof' then 'variant_of' when {label(col)} in ({', '.join(map(S.text, RELATIONS))}) then {label(col)} end")


def normalise(candidates: DataFrame, fragments: DataFrame | None, min_confidence: float = 0.35) -> tuple[DataFrame, DataFrame]:
    """(candidates with normalised text, id, confidence and known fragments; diagnostics of those dropped).

    Without ``fragments`` the candidates are taken to be as :func:`extract` makes them: texts normalised, fragments known.
    """
    df = candidates
    if fragments is not None:
        df = once(df.withColumn("_bare", F.expr(S.canonical("canonical_text"))), canonical_text=S.canonical_done("_bare")).drop("_bare")
        df = df.withColumn("id", proposition_id()).withColumn("confidence", F.expr(S.clamp("confidence")))
        known = df.select("document_id", "pos", F.posexplode("fragment_ids").alias("n", "id")).join(fragments.select("document_id", "id"), ["document_id", "id"], "left_semi")
        kept = known.groupBy("document_id", "pos").agg(F.sort_array(F.collect_list(F.struct("n", "id"))).alias("known"))
        first = fragments.groupBy("document_id").agg(F.min_by("id", "pos").alias("first_fragment"))
        df = df.join(kept, ["document_id", "pos"], "left").join(first, "document_id", "left")
        df = df.withColumn("fragment_ids", F.expr("if(known is not null, transform(known, x -> x.id), if(first_fragment is null, cast(array() as array<string>), array(first_fragment)))")).drop("known", "first_fragment")
    empty = df.filter("canonical_text = ''").select("document_id", F.lit("empty_candidate").alias("code"), F.lit("warning").alias("severity"), F.lit("claim without text").alias("message"), F.lit(None).cast("string").alias("target_id"))
    full = df.filter("canonical_text <> ''")
    low = full.filter(F.col("confidence") < min_confidence).select(
        "document_id", F.lit("low_confidence_candidate").alias("code"), F.lit("info").alias("severity"), F.concat("id", F.lit(": too little confidence")).alias("message"), F.col("id").alias("target_id")
    )
    return full.filter(F.col("confidence") >= min_confidence), empty.unionByName(low)


def role_scores() -> Column:
    return F.expr(S.role_score("role"))


assert set(R.ROLE_SCORES) <= {*ROLES, "unknown"}
