"""Run configuration from defaults, environment, JSON objects or command-line arguments."""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass, field, fields, replace

from ..functions.rules import STAGES

BACKENDS = {"nlp_mode": ("heuristic", "local-models"), "embedding_backend": ("deterministic", "text-retrieval"), "term_extraction_backend": ("heuristic", "text-linguistics"), "classification_backend": ("heuristic", "text-linguistics")}
ENVIRONMENT = {"artifact_dir": "QUILLSPAN_ARTIFACT_DIR", "model_primary": "QUILLSPAN_MODEL_PRIMARY", "model_cheap": "QUILLSPAN_MODEL_CHEAP", "lean_bin": "QUILLSPAN_LEAN_BIN"}


@dataclass(frozen=True)
class Config:
    worldview_id: str | None = None
    label: str | None = None
    min_confidence: float = 0.35
    max_propositions: int | None = None
    include_relations: bool = True
    artifact_dir: str = ".artifacts"
    persist_artifacts: bool = True
    model_primary: str = "gpt-5.5"
    model_cheap: str = "gpt-5.5-mini"
    embedding_model: str = "sentence-transformers/all-MiniLM-L6-v2"
    ner_model: str = "rust-bert-default-ner"
    nlp_mode: str = "heuristic"
    model_bundle_dir: str = ".models"
    auto_download_models: bool = False
    embedding_backend: str = "deterministic"
    term_extraction_backend: str = "heuristic"
    classification_backend: str = "heuristic"
    lean_bin: str = "lean"
    stage_through: str | None = None
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def rerank(self) -> bool:
        return self.embedding_backend == "text-retrieval" or self.nlp_mode == "local-models"

    @property
    def model_terms(self) -> bool:
        return self.term_extraction_backend == "text-linguistics" or self.nlp_mode == "local-models"

    @property
    def stages(self) -> list[str]:
        """Stages that run: all up to ``stage_through``."""
        return STAGES if self.stage_through is None else STAGES[: STAGES.index(self.stage_through) + 1]


def spelling(value: str, allowed: tuple[str, ...] | list[str]) -> str:
    """The allowed name that ``value`` stands for; ``-`` and ``_`` are the same."""
    for name in allowed:
        if name.replace("-", "_") == value.strip().lower().replace("-", "_"):
            return name
    raise ValueError(f"unknown value {value!r}; expected one of {', '.join(allowed)}")


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(w.capitalize() for w in rest)


def checked(values: dict) -> Config:
    out = {}
    for name, value in values.items():
        if value is None:
            continue
        if name in BACKENDS:
            value = spelling(value, BACKENDS[name])
        elif name == "stage_through":
            value = spelling(value, STAGES)
        elif name == "min_confidence":
            value = float(value)
        elif name == "max_propositions":
            value = int(value)
            if value < 0:
                raise ValueError("max_propositions must not be negative")
        out[name] = value
    config = Config(**out)
    return replace(config, auto_download_models=True) if config.nlp_mode == "local-models" else config


def from_environment(**values) -> Config:
    own = {k: os.environ[v] for k, v in ENVIRONMENT.items() if v in os.environ}
    return checked(own | values)


def from_json(values: dict) -> Config:
    """Keys in camel case (or as attributes are spelled); unknown keys are ignored."""
    known = {f.name for f in fields(Config)} - {"extra"}
    own = {k: values[camel(k)] if camel(k) in values else values.get(k) for k in known}
    return from_environment(**{k: v for k, v in own.items() if v is not None})


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quillspan", description="Extract source-grounded claims from a text.")
    p.add_argument("input", nargs="?", help="a text file; standard input if absent")
    for f in fields(Config):
        flag = "--" + f.name.replace("_", "-")
        if f.name == "extra":
            continue
        if f.type == "bool":
            p.add_argument(flag, action=argparse.BooleanOptionalAction, default=None)
        else:
            p.add_argument(flag)
    for name in ("id", "kind", "title", "language", "uri", "output"):
        p.add_argument(f"--{name}")
    p.add_argument("--author", action="append", default=[])
    p.add_argument("--worldview-only", action="store_true")
    p.add_argument("--pretty", action="store_true")
    return p


def from_arguments(argv: list[str]) -> tuple[argparse.Namespace, Config]:
    args = parser().parse_args(argv)
    names = {f.name for f in fields(Config)} - {"extra"}
    return args, from_environment(**{k: v for k, v in vars(args).items() if k in names and v is not None})
