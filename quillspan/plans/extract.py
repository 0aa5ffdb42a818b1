"""Whole extraction runs over many documents at once, with stage gates, summaries and written artifacts."""

from __future__ import annotations

import json
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import arguments, claims, dedup, embed, formal, rank, relate, segment, spans, terms, whole, worldview
from ..session import discard, write_and_read
from ..sources.config import Config

#: The file of each stage's artifact.
FILES = {s: f"{i:02d}_{s}.json" for i, s in enumerate(R.STAGES, 1)} | {"candidate_index": "09_candidate_index.json"}


class Extraction:
    """One run over documents. Every table is a plan until something reads it; tables that several stages share are written to
    the shared folder (``keep``), so they are computed once and plans stay short."""

    def __init__(self, documents: DataFrame, config: Config = Config(), keep: bool = True, ner=None):
        self.documents, self.config, self.keep, self.ner = documents, config, keep, ner
        self._written: list[tuple[str, str]] = []

    def _share(self, df: DataFrame, name: str) -> DataFrame:
        if not self.keep:
            return df
        shared, path = write_and_read(df, name)
        self._written.append((name, path))
        return shared

    def export(self) -> DataFrame:
        """``worldviews()`` for those who need nothing else: tables that only the index and the relations are made from are removed first.

        The run's other tables are made anew if they are asked for later; tables that were handed out before can't be read any more.
        """
        self.first_pass, self.role_of, self.relations  # noqa: B018
        self._leave("ranked", "roles", "passages", "relations")
        self.index  # noqa: B018
        self._leave("passages", "relations", "index")
        return self.worldviews()

    def whole(self) -> DataFrame:
        """``worldviews()`` in one pass over the documents, for those who need nothing else: no table is written, and rows with the same document_id stay apart."""
        return whole.worldviews(self.documents, self.config)

    def _leave(self, *names: str) -> None:
        """Remove all written tables but these; what was made from others is made anew if asked for."""
        for name, path in self._written:
            if name not in names:
                discard(self.documents.sparkSession, path)
        self._written = [w for w in self._written if w[0] in names]
        attributes = {"ranked": "first_pass", "roles": "role_of", "passages": "fragments"}
        held = {"ingested", *names, *(attributes.get(n, n) for n in names)}
        for name in [n for n in vars(self) if isinstance(getattr(type(self), n, None), cached_property) and n not in held]:
            del self.__dict__[name]

    @cached_property
    def ingested(self) -> DataFrame:
        return segment.ingest(self.documents)

    @cached_property
    def passages(self) -> DataFrame:
        return self._share(segment.passages(self.ingested), "passages")

    @cached_property
    def fragments(self) -> DataFrame:
        return segment.fragments(self.passages)

    @cached_property
    def embeddings(self) -> DataFrame:
        if self.config.rerank:
            return embed.RetrievalProvider().apply(self.passages)
        return embed.DeterministicProvider().apply(self.passages)

    @cached_property
    def clusters(self) -> DataFrame:
        return embed.clusters(self.embeddings)

    @cached_property
    def raw_candidates(self) -> DataFrame:
        return self._share(claims.extract(self.fragments), "candidates")

    @cached_property
    def claims(self) -> DataFrame:
        return claims.claim_candidates(self.raw_candidates, self.passages)

    @cached_property
    def roles(self) -> DataFrame:
        return claims.roles(self.raw_candidates, self.config.classification_backend == "text-linguistics")

    @cached_property
    def role_of(self) -> DataFrame:
        return self._share(claims.last_roles(self.roles), "roles")

    @cached_property
    def terms(self) -> DataFrame:
        own = terms.heuristic_terms(self.passages)
        if self.config.model_terms and self.ner is not None:
            return terms.merge_terms(own, terms.entity_terms(self.ner(self.passages)))
        return own

    @cached_property
    def arguments(self) -> DataFrame:
        return self._share(arguments.reconstruct(self.clusters, self.raw_candidates, self.role_of), "arguments")

    @cached_property
    def _normalised(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        kept, dropped = claims.normalise(self.raw_candidates, None, self.config.min_confidence)
        merged, notes = dedup.merge(kept)
        return self._share(merged, "propositions"), dropped, notes

    @property
    def propositions(self) -> DataFrame:
        """Candidates after normalisation and merging, in normalised order."""
        return self._normalised[0]

    def _none(self) -> DataFrame:
        return self.propositions.sparkSession.createDataFrame([], relate.RELATION)

    @cached_property
    def lexical(self) -> DataFrame:
        """Relations of the first pass."""
        return self._share(relate.relations(self.propositions, self.config.rerank, self._share if self.keep else None), "lexical")

    @cached_property
    def first_pass(self) -> DataFrame:
        found = self.lexical if self.config.include_relations else self._none()
        index = rank.rank(rank.score(self.propositions, self.passages, self.role_of, found))
        if self.config.max_propositions is not None:
            index = index.filter(F.col("pos") <= self.config.max_propositions)
        return self._share(index.select(*self.propositions.columns), "ranked")

    @cached_property
    def relations(self) -> DataFrame:
        if not self.config.include_relations:
            return self._none()
        found = relate.relations(self.first_pass, self.config.rerank, self._share if self.keep else None)
        return self._share(found.unionByName(relate.argument_relations(self.arguments)), "relations")

    @cached_property
    def index(self) -> DataFrame:
        """Scored and ranked candidates with what ranking recorded."""
        return self._share(rank.metadata(rank.rank(rank.score(self.first_pass, self.passages, self.role_of, self.relations))), "index")

    @cached_property
    def normalised_propositions(self) -> DataFrame:
        return formal.normalised_propositions(self.index, self.role_of)

    @cached_property
    def formalisations(self) -> DataFrame:
        return formal.formalise(self.normalised_propositions)

    @cached_property
    def evaluations(self) -> DataFrame:
        return formal.evaluate(self.formalisations, self.config.lean_bin)

    def worldviews(self, pretty: bool = False) -> DataFrame:
        return worldview.build(self.ingested, self.fragments, self.index, self.relations, self.config.worldview_id, self.config.label, pretty)

    @cached_property
    def diagnostics(self) -> DataFrame:
        """document_id, code, severity, message, target_id of everything worth a note."""
        kept, dropped, merged = self._normalised
        note = lambda df, code, message: df.select("document_id", F.lit(code).alias("code"), F.lit("warning").alias("severity"), F.lit(message).alias("message"), F.lit(None).cast("string").alias("target_id"))
        without = lambda df: self.ingested.select("document_id").join(df.select("document_id").distinct(), "document_id", "left_anti")
        parts = [
            note(without(self.fragments), "no_fragments", "document without passages"), note(without(self.claims), "no_claim_candidates", "document without claims"),
            dropped, merged, rank.variant_diagnostics(self.relations), rank.rank_diagnostics(self.index),
        ]
        if self.config.model_terms and self.ner is None:
            parts.append(terms.ner_unavailable(self.ingested, "no model is configured"))
        return reduce(DataFrame.unionByName, parts)

    #: The table of each stage, by stage name.
    def table(self, stage: str) -> DataFrame:
        return {
            "ingest": lambda: self.ingested, "segment": lambda: self.passages, "embed": lambda: self.embeddings.select("document_id", F.col("id").alias("passage_id"), F.size("vector").alias("dimensions"), "vector"), "cluster": lambda: self.clusters,
            "extract_claims": lambda: self.claims, "classify_roles": lambda: self.roles, "extract_terms": lambda: self.terms, "reconstruct_arguments": lambda: self.arguments, "normalize_propositions": lambda: self.normalised_propositions,
            "formalize": lambda: self.formalisations, "evaluate": lambda: self.evaluations, "worldview": lambda: self.worldviews(), "candidate_index": lambda: self.index, "relate": lambda: self.relations,
        }[stage]()

    def summaries(self) -> DataFrame:
        """name, output_count of every stage that runs; ``relate`` stands between normalisation and formalisation."""
        names = list(self.config.stages)
        if "formalize" in names:
            names.insert(names.index("formalize"), "relate")
        counts = [self.table("candidate_index" if n == "normalize_propositions" else n).agg(F.count("*").alias("output_count")).select(F.lit(i).alias("place"), F.lit(n).alias("name"), "output_count") for i, n in enumerate(names)]
        return reduce(DataFrame.unionByName, counts)

    def response(self) -> dict[str, DataFrame]:
        """The tables of a run's result; a run that stops early has no candidates, index or worldviews."""
        if self.config.stages[-1] != "worldview":
            return {"stages": self.summaries()}
        return {"candidates": self.index, "candidate_index": self.index, "relations": self.relations, "worldviews": self.worldviews(), "diagnostics": self.diagnostics, "stages": self.summaries()}

    def provider_metadata(self, stage: str) -> str:
        """What is recorded about the provider of a stage, as JSON."""
        c = self.config
        model, backend, task = {
            "embed": (c.embedding_model, c.embedding_backend, "text-embedding"), "classify_roles": (c.model_primary, c.classification_backend, "text-classification"), "extract_terms": (c.ner_model, c.term_extraction_backend, "token-classification"),
        }.get(stage, ("heuristic-v1", "heuristic", stage))
        return json.dumps({"autoDownloadModels": c.auto_download_models, "backend": backend, "modelBundleDir": c.model_bundle_dir, "modelId": model, "taskCategory": task})

    def write(self, folder: str | None = None) -> list[dict]:
        """Write each stage's table as JSON in an envelope of run, stage and provider; gives the artifacts' references.

        The manifest is written only by runs that reach the last stage.
        """
        if not self.config.persist_artifacts:
            return []
        folder = folder or self.config.artifact_dir
        runs = self.ingested.select(F.col("document_id"), "run_id")
        refs, before = [], []
        names = [n for s in self.config.stages for n in ([s, "candidate_index"] if s == "normalize_propositions" else [s])]
        for name in names:
            table = self.table(name)
            rows = table.drop("run_id").join(runs, "document_id", "left") if "document_id" in table.columns else table.withColumn("run_id", F.lit(None).cast("string"))
            payload = F.struct(*[c for c in rows.columns if c != "run_id"])
            envelope = rows.select("run_id", F.lit(name).alias("stage"), F.lit("quillspan").alias("provider"), F.lit("1").alias("providerVersion"), F.lit(self.provider_metadata(name)).alias("metadata"), F.array(*[F.lit(x) for x in before]).cast("array<string>").alias("inputArtifactIds"), F.concat(F.lit("unix:"), F.unix_timestamp().cast("string")).alias("createdAt"), payload.alias("payload"))
            envelope.write.mode("overwrite").json(f"{folder}/{FILES[name]}")
            refs.append({"id": name, "path": f"{folder}/{FILES[name]}", "stage": "normalize_propositions" if name == "candidate_index" else name})
            before = [name]
        if self.config.stages[-1] == "worldview":
            config = {k: v for k, v in vars(self.config).items() if k != "extra"}
            spark = self.documents.sparkSession
            spark.createDataFrame([(json.dumps({"config": config, "artifacts": refs}, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/manifest.json")
        return refs


def extract_spans(batch, config: Config = Config(), media: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(candidates, diagnostics) of a span batch: one span gives one candidate at most; no ranking, no relations.

    ``media``: tables ``evidence``, ``scenes``, ``tracks`` and ``sponsor_segments``; adds ``media_context`` (a list of JSON texts).
    """
    spans.require(spans.span_violations(batch.sources, batch.spans))
    fragments = spans.span_fragments(batch.spans)
    kept, dropped = claims.normalise(claims.extract(fragments), fragments, config.min_confidence)
    merged, notes = dedup.merge(kept)
    found = spans.source_segments(merged, batch.spans)
    if media is not None:
        contexts = spans.media_context(batch.spans, media["evidence"], media["scenes"], media["tracks"], media["sponsor_segments"])
        spots = found.select("document_id", "id", F.posexplode("fragment_ids").alias("n", "span_id")).join(contexts, "span_id")
        lists = spots.groupBy("document_id", "id").agg(F.sort_array(F.collect_list(F.struct("n", "context"))).alias("c")).select("document_id", "id", F.expr("transform(c, x -> x.context)").alias("media_context"))
        found = found.join(lists, ["document_id", "id"], "left")
    if config.max_propositions is not None:
        found = found.filter(F.col("pos") <= config.max_propositions)
    return found, dropped.unionByName(notes)
