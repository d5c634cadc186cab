"""A registered tool behind the interface that trainers call: create, execute, score, release."""

from __future__ import annotations

import json
import uuid

from .registry import Registry
from .results import compact


class TrainerTool:
    def __init__(self, registry: Registry, name: str):
        self.registry, self.name = registry, name
        self._live: set[str] = set()

    @property
    def schema(self) -> dict:
        return self.registry.get(self.name).schema

    def create(self, instance: str | None = None, create_kwargs: dict | None = None) -> str:
        """A new instance; missing or null keyword arguments are an empty mapping."""
        ident = instance or uuid.uuid4().hex
        self._live.add(ident)
        return ident

    def execute(self, instance: str, arguments: dict | str) -> tuple[str, float, dict]:
        """(result as JSON text, step reward 0, metrics)."""
        if isinstance(arguments, str):
            try:
                arguments = json.loads(arguments)
            except ValueError:
                arguments = {"": None}
        out = self.registry.invoke(self.name, arguments)
        return json.dumps(compact(out), ensure_ascii=False), 0.0, {"status": out["status"], "completion": out["completion"]}

    def score(self, instance: str) -> float:
        return 0.0

    def release(self, instance: str) -> None:
        self._live.discard(instance)
