"""Settings of a run, typed; what a settings file leaves out has these values."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields, is_dataclass

from .schemas import NO_ANSWER_BOOST, TOP_K


@dataclass(frozen=True)
class Extraction:
    min_paragraph_length: int = 30
    use_extractions: bool = True
    store_extractions: bool = True


@dataclass(frozen=True)
class Curation:
    neg_pos_ratio: int = 1
    create_neg_samples: bool = True
    seed: int = 42
    val_ratio: float = 0.2
    skip_pages: int = 3
    find_new_answerable: bool = True
    create_unanswerable: bool = True
    excluded_companies: tuple[str, ...] = ("CEZ",)


@dataclass(frozen=True)
class Relevance:
    threshold: float = 0.5
    batch_size: int = 16
    sectors: tuple[str, ...] = ("OG", "CM", "CU")


@dataclass(frozen=True)
class Answers:
    top_k: int = TOP_K
    no_ans_boost: float = NO_ANSWER_BOOST
    n_best: int = 2
    batch_size: int = 16


@dataclass(frozen=True)
class Rules:
    default_year: int = 2019
    ignore_years: bool = False
    two_pages: bool = False
    clusters: bool = False
    only_kpis: tuple[float, ...] = ()


@dataclass(frozen=True)
class Settings:
    """All of them. load() refuses names that it does not know and values of another type."""

    project: str = "project"
    extraction: Extraction = field(default_factory=Extraction)
    curation: Curation = field(default_factory=Curation)
    relevance: Relevance = field(default_factory=Relevance)
    answers: Answers = field(default_factory=Answers)
    rules: Rules = field(default_factory=Rules)

    @classmethod
    def load(cls, text: str) -> Settings:
        return _made(cls, json.loads(text), "settings")

    def dump(self) -> str:
        return json.dumps(asdict(self), indent=1)


def _made(kind: type, values: dict, where: str):
    default = kind()
    known = {f.name: getattr(default, f.name) for f in fields(kind)}
    out = {}
    for name, value in values.items():
        if name not in known:
            raise ValueError(f"{where}: no setting {name}")
        have = known[name]
        if is_dataclass(have):
            out[name] = _made(type(have), value, f"{where}.{name}")
        elif isinstance(have, tuple) and isinstance(value, list):
            out[name] = tuple(value)
        elif isinstance(have, float) and isinstance(value, int) and not isinstance(value, bool):
            out[name] = float(value)
        elif type(value) is type(have):
            out[name] = value
        else:
            raise ValueError(f"{where}.{name}: {value!r} is no {type(have).__name__}")
    return kind(**out)
