"""Configuration of a run: strict, validated, with a hash that names it."""

from __future__ import annotations

import hashlib
import json
import typing
from dataclasses import asdict, dataclass, field, fields, is_dataclass
from typing import Any

from ..operators.exporting import check_ratios
from ..operators.generation import TASKS


class ConfigError(ValueError):
    """A configuration that can't be run."""


def _need(ok: bool, message: str) -> None:
    if not ok:
        raise ConfigError(message)


@dataclass(frozen=True)
class Source:
    plugin: str = "local"
    params: dict[str, Any] = field(default_factory=dict)
    field_map: dict[str, str] = field(default_factory=dict)
    filters: dict[str, Any] = field(default_factory=dict)
    profile: str | None = None


@dataclass(frozen=True)
class Selection:
    count: int | None = None
    fraction: float | None = None
    seed: int = 42
    strata: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        _need((self.count is None) != (self.fraction is None), "selection: give exactly one of count and fraction")
        _need(self.count is None or self.count > 0, "selection: count is positive")
        _need(self.fraction is None or 0 < self.fraction <= 1, "selection: fraction is above 0 and at most 1")


@dataclass(frozen=True)
class Distribution:
    weights: dict[str, float] | None = None
    counts: dict[str, int] | None = None

    def __post_init__(self) -> None:
        _need((self.weights is None) != (self.counts is None), "distribution: give exactly one of weights and counts")
        _need(all(w > 0 for w in (self.weights or {}).values()), "distribution: weights are positive")
        _need(all(n >= 0 for n in (self.counts or {}).values()), "distribution: counts are not negative")
        _need(bool(self.weights or self.counts), "distribution: at least one name")


@dataclass(frozen=True)
class Target:
    examples: int = 100
    minimum: int = 1
    maximum: int = 3
    reserve_fraction: float = 0.0
    same_document_attempts: int = 2
    max_attempts_per_slot: int = 5
    max_total_attempt_multiplier: float = 3.0

    def __post_init__(self) -> None:
        _need(self.examples > 0, "target: examples is positive")
        _need(0 <= self.minimum <= self.maximum and self.maximum > 0, "target: 0 <= minimum <= maximum")
        _need(0 <= self.reserve_fraction < 1, "target: reserve_fraction is at least 0 and below 1")
        _need(self.same_document_attempts > 0 and self.max_attempts_per_slot > 0, "target: attempts are positive")
        _need(self.max_total_attempt_multiplier >= 1, "target: max_total_attempt_multiplier is at least 1")


@dataclass(frozen=True)
class Generation:
    backend: str = "fake"
    model: str = "fake-generator"
    language: str = "en"
    chunk_size: int = 8000
    chunk_overlap: int = 400
    context_tokens: int = 65_536
    max_input_tokens: int = 53_248
    max_output_tokens: int = 4096
    in_flight: int = 32
    queue: int = 64
    ordered: bool = False
    keep_raw: bool = False
    params: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        _need(0 <= self.chunk_overlap < self.chunk_size, "generation: the overlap is below the chunk size")
        _need(self.max_input_tokens + self.max_output_tokens <= self.context_tokens, "generation: input and output fit the context")
        _need(self.queue >= self.in_flight > 0, "generation: the queue holds at least what is in flight")


@dataclass(frozen=True)
class Output:
    formats: list[str] = field(default_factory=lambda: ["messages"])
    containers: list[str] = field(default_factory=lambda: ["jsonl"])
    splits: dict[str, float] = field(default_factory=lambda: {"train": 1.0})
    shard_rows: int = 10_000

    def __post_init__(self) -> None:
        try:
            check_ratios(self.splits)
        except ValueError as e:
            raise ConfigError(f"output: {e}") from e
        _need(bool(self.formats) and bool(self.containers), "output: at least one format and container")
        _need(set(self.containers) <= {"jsonl", "parquet"}, "output: containers are jsonl and parquet")


@dataclass(frozen=True)
class Runtime:
    scheduler_batch: int = 4096
    max_rounds: int = 1000

    def __post_init__(self) -> None:
        _need(self.scheduler_batch > 0 and self.max_rounds > 0, "runtime: sizes are positive")


@dataclass(frozen=True)
class Project:
    name: str = "synthetic-sft"
    source: Source = field(default_factory=Source)
    selection: Selection = field(default_factory=lambda: Selection(fraction=1.0))
    tasks: Distribution = field(default_factory=lambda: Distribution(weights=dict.fromkeys(TASKS, 1.0)))
    difficulties: Distribution = field(default_factory=lambda: Distribution(weights={"easy": 1.0, "medium": 1.0, "hard": 1.0}))
    target: Target = field(default_factory=Target)
    generation: Generation = field(default_factory=Generation)
    output: Output = field(default_factory=Output)
    runtime: Runtime = field(default_factory=Runtime)

    def __post_init__(self) -> None:
        _need(self.target.minimum <= self.target.examples, "target: the minimum a document is at most the examples")

    @property
    def hash(self) -> str:
        """SHA-256 of the canonical JSON: what is left at its default says nothing, so new options don't change old hashes."""
        plain = Project()
        own = {k: v for k, v in asdict(self).items() if v != asdict(plain)[k]}
        return hashlib.sha256(json.dumps(own, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def build(kind: type, value: dict[str, Any], where: str = "config") -> Any:
    """A dataclass of plain JSON; a key that it doesn't know is an error."""
    _need(isinstance(value, dict), f"{where}: an object is needed")
    known = {f.name: f for f in fields(kind)}
    unknown = sorted(set(value) - set(known))
    _need(not unknown, f"{where}: unknown keys {', '.join(unknown)}")
    hints = typing.get_type_hints(kind)
    return kind(**{k: build(hints[k], v, f"{where}.{k}") if is_dataclass(hints[k]) else v for k, v in value.items()})


def load(path: str) -> Project:
    with open(path, encoding="utf-8") as f:
        return build(Project, json.load(f))


def dump(project: Project) -> dict[str, Any]:
    return asdict(project)


def schema(kind: type = Project) -> dict[str, Any]:
    """JSON schema of the configuration."""
    plain = {int: "integer", float: "number", str: "string", bool: "boolean"}
    hints = typing.get_type_hints(kind)

    def one(hint: Any) -> dict[str, Any]:
        if is_dataclass(hint):
            return schema(hint)
        args = [a for a in typing.get_args(hint) if a is not type(None)]
        origin = typing.get_origin(hint)
        if origin is list:
            return {"type": "array", "items": one(args[0])}
        if origin is dict:
            return {"type": "object", "additionalProperties": one(args[1])}
        if args:
            return {"anyOf": [*(one(a) for a in args), {"type": "null"}]}
        return {"type": plain[hint]} if hint in plain else {}

    return {"type": "object", "additionalProperties": False, "properties": {f.name: one(hints[f.name]) for f in fields(kind)}}
