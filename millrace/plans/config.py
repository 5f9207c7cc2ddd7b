"""Parameters of a run, their defaults and their files."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path

from ..functions.patterns import STYLES


@dataclass
class Seed:
    source: str = "jsonl"
    path: str = ""
    n_docs: int | None = 500
    min_chars: int = 500
    max_chars: int = 8000
    language: str = "zh"
    filter: str = "auto"

    @property
    def english_labels(self) -> bool:
        """'auto' means the English labels for English seeds, 'en-soft' always, 'none' never."""
        return self.filter == "en-soft" or (self.filter == "auto" and self.language == "en")


@dataclass
class Model:
    name: str = ""
    temperature: float = 0.7
    judge_temperature: float = 0.0
    max_tokens: int = 3072
    timeout_seconds: float = 600.0
    retries: int = 3


@dataclass
class Synthesis:
    do_qa: bool = True
    do_rewrite: bool = True
    qa_min_pairs: int = 3
    qa_max_pairs: int = 8
    styles: list[str] = field(default_factory=lambda: list(STYLES))
    labels: str = "auto"


@dataclass
class Config:
    seed: Seed = field(default_factory=Seed)
    llm: Model = field(default_factory=Model)
    synthesis: Synthesis = field(default_factory=Synthesis)
    output: str = "out"


def _fill(kind, values: dict):
    known = {f.name: f for f in fields(kind)}
    if unknown := set(values) - set(known):
        raise ValueError(f"unknown settings of {kind.__name__}: {', '.join(sorted(unknown))}")
    made = kind()
    for k, v in values.items():
        now = getattr(made, k)
        setattr(made, k, _fill(type(now), v) if is_dataclass(now) and isinstance(v, dict) else v)
    return made


def load(path: str) -> Config:
    """From a JSON file, or a YAML one where a YAML library is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("YAML files need the yaml package; JSON ones don't") from e
        return _fill(Config, yaml.safe_load(text) or {})
    return _fill(Config, json.loads(text))


def template(path: str) -> str:
    return Path(path).read_text(encoding="utf-8")
