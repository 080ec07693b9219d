"""What has been registered, and counts of its use."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark import Accumulator, SparkContext

from ..types import LType, signature
from .plan import Plan

COUNTERS = ("batches", "rows", "calls", "null_skips", "errors_to_null")


@dataclass
class Registration:
    """A function as it was registered. Counts come from accumulators: a task that runs again counts again, so they mean "at least"."""

    name: str
    kind: str
    args: list[LType] | None
    returns: LType | None
    plan: Plan
    options: dict[str, Any]
    udf: Any = None
    counters: dict[str, Accumulator] = field(default_factory=dict)

    def __repr__(self) -> str:
        text = self.name if self.returns is None else signature(self.name, self.args, self.returns)
        return f"<{self.kind} {text}; plan {self.plan.name}>"

    def counted(self, context: SparkContext) -> dict[str, Accumulator]:
        self.counters = {x: context.accumulator(0) for x in COUNTERS}
        return self.counters

    def explained(self) -> dict[str, Any]:
        types = {"signature": signature(self.name, self.args, self.returns) if self.returns else None, "dynamic": self.args is None, "args": self.args and [x.token for x in self.args], "returns": self.returns and self.returns.token}
        return {"name": self.name, "kind": self.kind, **types, "plan": self.plan.name, **self.options, **{k: v.value for k, v in self.counters.items()}}
