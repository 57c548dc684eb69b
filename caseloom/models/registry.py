"""Models by name with their inputs, tags and rules, and a way to build some of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame

from caseloom.quality.rules import Rule, run_rules


@dataclass(frozen=True)
class Model:
    """A relation built from other relations. ``stored`` models are written as tables."""

    name: str
    build: Callable[..., DataFrame]
    inputs: Sequence[str] = ()
    tags: frozenset[str] = frozenset()
    stored: bool = True
    rules: Callable[[], Sequence[Rule]] = list


@dataclass
class Warehouse:
    """Source tables, models on them, and the relations built so far."""

    sources: dict[str, DataFrame]
    models: dict[str, Model] = field(default_factory=dict)
    built: dict[str, DataFrame] = field(default_factory=dict)

    def add(self, model: Model) -> None:
        if model.name in self.models or model.name in self.sources:
            raise ValueError(f"relation {model.name!r} exists")
        self.models[model.name] = model

    def ref(self, name: str, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """A source or model by name; a model is built after its inputs, once."""
        if name in self.sources:
            return self.sources[name]
        if name not in self.built:
            model = self.models[name]
            df = model.build(*[self.ref(i, store) for i in model.inputs])
            self.built[name] = store(df, name) if model.stored else df
        return self.built[name]

    def select(self, expression: str) -> list[str]:
        """Model names for ``name`` or ``tag:x``, with ``+`` before for what it needs
        and after for what needs it."""
        core = expression.strip("+")
        if core.startswith("tag:"):
            chosen = {m.name for m in self.models.values() if core[4:] in m.tags}
        else:
            chosen = {self.models[core].name}
        before = self._reach(chosen, lambda n: self.models[n].inputs) if expression.startswith("+") else chosen
        after = self._reach(chosen, self._users) if expression.endswith("+") else chosen
        return [n for n in self.models if n in before | after]

    def _users(self, name: str) -> list[str]:
        return [m.name for m in self.models.values() if name in m.inputs]

    def _reach(self, start: set[str], step: Callable[[str], Sequence[str]]) -> set[str]:
        seen, todo = set(start), list(start)
        while todo:
            for name in step(todo.pop()):
                if name in self.models and name not in seen:
                    seen.add(name)
                    todo.append(name)
        return seen

    def run(self, expression: str, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame | None:
        """Build the selected models, check their rules, return one result row per rule."""
        results = []
        for name in self.select(expression):
            df = self.ref(name, store)
            rules = self.models[name].rules()
            if rules:
                results.append(run_rules(name, df, rules))
        return reduce(DataFrame.unionByName, results) if results else None
