"""Python helpers as functions of columns, within a block: names become registered functions, and nothing runs locally."""

from __future__ import annotations

from collections.abc import Callable
from types import TracebackType
from typing import TYPE_CHECKING, Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .types import LType, normalize

if TYPE_CHECKING:
    from .engine import Engine


class Bridge:
    """``with engine.bind({"score": F64}, score=fun) as b: df.withColumn("s", b.score("x"))``.

    A name that was not given, or has no function, is an error; there is no way back to local
    evaluation.
    """

    def __init__(self, engine: Engine, returns: dict[str, LType | str], helpers: dict[str, Callable], **options: Any):
        if not returns:
            raise ValueError("returns names each helper and its type")
        missing = set(returns) - set(helpers)
        if missing:
            raise NameError(f"no such helper: {', '.join(sorted(missing))}")
        self._calls = {}
        for name, kind in returns.items():
            made = engine.register_scalar(f"bound_{name}", helpers[name], returns=normalize(kind), **options)
            self._calls[name] = made.udf

    def __getattr__(self, name: str) -> Callable[..., Column]:
        calls = self.__dict__.get("_calls", {})
        if name not in calls:
            raise AttributeError(f"{name} is not bound")
        return lambda *columns: calls[name](*(F.col(x) if isinstance(x, str) else x for x in columns))

    def __enter__(self) -> Bridge:
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        self._calls = {}
