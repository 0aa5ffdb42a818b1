"""Boundaries to models that can be plugged in, and the providers that stand in for them."""

from __future__ import annotations

from abc import ABC, abstractmethod
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import SPARK as S
from ..session import ship
from .formal import lean


class ProviderError(RuntimeError):
    """A provider could not answer; stages report it as a diagnostic and go on without it."""


@dataclass(frozen=True)
class StructuredPrompt:
    instructions: str
    text: str
    schema: dict


@dataclass(frozen=True)
class Classification:
    label: str
    confidence: float


class TextGenerationProvider(ABC):
    name: str
    model: str

    @abstractmethod
    def generate_structured(self, prompt: StructuredPrompt) -> dict: ...


class UnconfiguredGeneration(TextGenerationProvider):
    """The default: there is no service to ask."""

    def __init__(self, model: str):
        self.name, self.model = "text-generation", model

    def generate_structured(self, prompt: StructuredPrompt) -> dict:
        raise ProviderError(f"no text generation service is configured for {self.model}")


class NerProvider(ABC):
    """Finds entities in batches of texts: (text, normalized, entity_type, confidence) each."""

    name: str
    model: str

    @abstractmethod
    def entities(self, texts: list[str]) -> list[list[tuple[str, str, str, float]]]: ...

    def __call__(self, passages: DataFrame) -> DataFrame:
        """The entities of passages, one row each, from Arrow batches."""
        kind = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("normalized", T.StringType()), T.StructField("entity_type", T.StringType()), T.StructField("confidence", T.DoubleType())]))
        provider = self
        ship(passages.sparkSession)

        @F.pandas_udf(kind)
        def run(texts: pd.Series) -> pd.Series:
            return pd.Series([[dict(zip(("text", "normalized", "entity_type", "confidence"), e, strict=True)) for e in found] for found in provider.entities(texts.tolist())])

        return passages.select("document_id", F.col("id").alias("passage_id"), F.explode(run("text")).alias("e")).select("document_id", "passage_id", "e.*")


class RuleNer(NerProvider):
    """Finds nothing."""

    name, model = "local-rule-ner", "none"

    def entities(self, texts: list[str]) -> list[list[tuple[str, str, str, float]]]:
        return [[] for _ in texts]


class HeuristicClassifier:
    """Cue words decide; as columns in :mod:`claims`, and for single texts here."""

    name = "local-heuristic-classifier"

    def __init__(self, model: str = "heuristic"):
        self.model = model

    @staticmethod
    def _lower(text: str) -> str:
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)

    def claim_kind(self, text: str) -> Classification:
        low = self._lower(text)
        if " if " in low or low.startswith("if "):
            kind = "conditional"
        elif " should " in low or " ought " in low:
            kind = "normative"
        else:
            kind = "atomic" if " is " in low or " are " in low else "unknown"
        return Classification(kind, 0.56)

    def role(self, text: str) -> Classification:
        low = self._lower(text)
        return Classification("conclusion" if "because" in low or "therefore" in low else "example" if "for example" in low else "premise", 0.56)

    def relation(self, left: str, right: str) -> Classification:
        return Classification("contradicts" if (" not " in left) != (" not " in right) else "supports", 0.52)


class LeanSource:
    """Writes Lean sources of formal stubs; never runs Lean."""

    name = "lean-source"

    def __init__(self, lean_bin: str = "lean"):
        self.lean_bin = lean_bin

    def evaluate(self, formalisation_id: str, tree: dict) -> tuple[str, dict]:
        """(source, diagnostic)."""
        name = "".join(c if c.isascii() and (c.isalnum() or c == "_") else "_" for c in formalisation_id)
        name = name if name[:1].isascii() and name[:1].isalpha() else f"p{name}"
        source = f"-- Lean binary: {self.lean_bin}\ndef {name} : Prop := {lean(tree)}\n#check {name}\n"
        return source, {"code": "lean_not_executed", "severity": "info", "message": "The source was written but not run.", "target_id": formalisation_id}


def metadata_flag(col: str, key: str) -> F.Column:
    """A Boolean of a JSON map; false if absent or anything else."""
    value = f"try_variant_get(try_parse_json({col}), {S.text('$.' + key)}, 'variant')"
    return F.expr(f"coalesce(if(schema_of_variant({value}) = 'BOOLEAN', try_cast({value} as boolean), false), false)")


def metadata_strings(col: str, key: str) -> F.Column:
    """The strings of a JSON map's list; none if absent or anything else."""
    values = f"try_variant_get(try_parse_json({col}), {S.text('$.' + key)}, 'array<variant>')"
    return F.expr(f"coalesce(transform(filter({values}, x -> schema_of_variant(x) = 'STRING'), x -> cast(x as string)), cast(array() as array<string>))")
