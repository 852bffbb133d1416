"""Plug-ins by kind and name: sources, tasks, backends, gates and layouts."""

from __future__ import annotations

from collections.abc import Callable
from importlib.metadata import entry_points
from typing import Any

from ..operators import exporting, gates, generation
from ..sources import readers

KINDS = ("sources", "tasks", "backends", "gates", "layouts")
_known: dict[str, dict[str, Any]] = {k: {} for k in KINDS}


def register(kind: str, name: str, value: Any) -> None:
    if kind not in _known:
        raise ValueError(f"unknown kind {kind!r}; one of {', '.join(KINDS)}")
    _known[kind][name] = value


def find(kind: str, name: str) -> Any:
    """What is registered, or what an installed package offers under sluice.<kind>."""
    if name not in _known.get(kind, {}):
        for e in entry_points(group=f"sluice.{kind}"):
            _known[kind].setdefault(e.name, e.load())
    try:
        return _known[kind][name]
    except KeyError:
        raise ValueError(f"unknown {kind} plug-in {name!r}; known: {', '.join(names(kind))}") from None


def names(kind: str) -> list[str]:
    return sorted(_known[kind])


def _local(spark, params: dict[str, Any]):
    return readers.read(spark, params["path"], params.get("format"), params.get("schema"))


def _model_on_gpu(**_params) -> Callable:
    raise NotImplementedError("a local model needs GPUs and its packages: register a Backend that loads it once a worker")


register("sources", "local", _local)
register("sources", "huggingface", readers.remote)
for _name, _guidance in generation.TASKS.items():
    register("tasks", _name, _guidance)
register("backends", "fake", lambda **_params: None)
register("backends", "openai_compatible", lambda **p: generation.HttpBackend(**p))
register("backends", "vllm_local", _model_on_gpu)
register("gates", "deterministic", gates.evaluate)
for _name, _layout in exporting.LAYOUTS.items():
    register("layouts", _name, _layout)
