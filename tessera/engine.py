"""The engine: registers functions with a Spark session, and keeps what it knows of them."""

from __future__ import annotations

import inspect
import warnings
from collections.abc import Callable
from typing import Any

import pyspark
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bridge import Bridge
from .operators import aggregate as agg
from .operators.scalar import evaluator
from .plans import plan as plans
from .plans.registry import Registration
from .sources import table
from .streaming.results import QueryStream
from .types import LType, normalize

VERSION = "1.0"
#: Versions of Spark that the engine knows.
SPARK = ("4.1",)


class Engine:
    """Functions stay registered after release(), and can be given to further sessions by attach(); there is no unregister."""

    def __init__(self, spark: SparkSession, plan: str | plans.Plan = "arrow"):
        if pyspark.__version__.rsplit(".", 1)[0] not in SPARK:
            raise RuntimeError(f"made for Spark {', '.join(SPARK)}, not {pyspark.__version__}")
        self.spark, self.version = spark, VERSION
        self._known: dict[str, Registration] = {}
        self._made: dict[str, Any] = {}
        self._streams: list[QueryStream] = []
        spark.conf.set("spark.sql.timeType.enabled", "true")  # for TIME
        self.set_plan(plan)

    # -- plans and life

    def set_plan(self, plan: str | plans.Plan, **options: int) -> plans.Plan:
        """The plan of functions registered from now on; nothing changes if it cannot be set."""
        new = plans.plan(plan, **options)
        plans.apply(self.spark, new)
        self._plan = new
        return new

    @property
    def plan(self) -> plans.Plan:
        return self._plan

    def backend(self) -> dict[str, object]:
        return plans.backend(self.spark)

    def attach(self, spark: SparkSession) -> None:
        """Gives all functions to another session of the same application."""
        for name, made in self._made.items():
            (spark.udtf if name in self._known and self._known[name].kind == "table" else spark.udf).register(name, made)

    def release(self) -> None:
        """Closes open result streams. Functions stay."""
        for x in self._streams:
            x.close()
        self._streams.clear()

    def capabilities(self) -> dict[str, bool]:
        """Which optional types the session can hold, by trying; what fails is not supported."""
        out = {}
        for name, sql in {"variant": "parse_json('1')", "time": "TIME '01:02:03'"}.items():
            try:
                self.spark.sql(f"SELECT {sql} AS x").collect()
                out[name] = True
            except Exception:  # noqa: BLE001
                out[name] = False
        return out

    # -- registration

    def _size(self, fun: Callable) -> None:
        n = len(cloudpickle.dumps(fun))
        if n > self._plan.most_bytes:
            raise ValueError(f"the function and what it refers to take {n} bytes, more than {self._plan.most_bytes}; use a broadcast variable")
        if n > self._plan.most_bytes // 2:
            warnings.warn(f"the function and what it refers to take {n} bytes, sent to every task", stacklevel=3)

    def register_scalar(self, name: str, fun: Callable, args: list[LType | str] | None = None, returns: LType | str | None = None, mode: str = "scalar", null_handling: str = "default", exception_handling: str = "rethrow", side_effects: bool = False) -> Registration:
        """A function of SQL and of call(). Without ``args`` it takes any arguments, of the types they have where it is called.

        null_handling: ``default`` (a NULL argument gives NULL, without a call) or ``special`` (None
        is passed). exception_handling: ``rethrow`` or ``return_null`` (of errors in the function;
        results of a wrong type are errors always). side_effects: Spark may not fold, repeat or move
        the call. A name that is registered again is replaced in queries made from then on.
        """
        if returns is None:
            raise TypeError("returns is needed")
        if null_handling not in ("default", "special") or exception_handling not in ("rethrow", "return_null"):
            raise ValueError("null_handling is default or special, exception_handling rethrow or return_null")
        chosen = None if args is None else [normalize(x) for x in args]
        self._plan.allows(mode, None if chosen is None else len(chosen))
        self._size(fun)
        options = {"mode": mode, "null_handling": null_handling, "exception_handling": exception_handling, "side_effects": side_effects}
        spec = Registration(name, "scalar", chosen, normalize(returns), self._plan, options)
        return self._keep(spec, evaluator(fun, spec, spec.counted(self.spark.sparkContext)))

    def _keep(self, spec: Registration, made: Any) -> Registration:
        spec.udf = made
        self._known[spec.name] = spec
        self._made[spec.name] = made
        (self.spark.udtf if spec.kind == "table" else self.spark.udf).register(spec.name, made)
        return spec

    def _find(self, name: str, kind: str) -> Registration:
        found = self._known.get(name)
        if found is None or found.kind != kind:
            raise NameError(f"no {kind} function {name!r}")
        return found

    def call(self, name: str, *columns: Column | str) -> Column:
        """A call, with arguments cast to the declared types."""
        spec = self._find(name, "scalar")
        given = [F.col(x) if isinstance(x, str) else x for x in columns]
        if spec.args is not None:
            if len(given) != len(spec.args):
                raise TypeError(f"{name} takes {len(spec.args)} arguments, not {len(given)}")
            given = [x if isinstance(a.spark, (T.VariantType, T.StructType)) else x.cast(a.spark) for x, a in zip(given, spec.args)]
        return spec.udf(*given)

    def register_aggregate(self, name: str, args: list[LType | str], returns: LType | str, null_handling: str = "default", **callbacks: Callable) -> Registration:
        """An aggregate; see operators.aggregate.Callbacks for ``callbacks``. Rows with a NULL are left out, or passed if ``special``.

        agg() and aggregate() use it; in SQL its name works alone in a GROUP BY or a window, as
        Spark allows for Python aggregates, with a call of Python for each group. For many groups SQL
        has ``<name>_rows(collect_list(x))``, or of several arguments ``<name>_rows(collect_list(struct(x, y)))``:
        the groups of a batch in one call, each of which fits in a row. Results are checked as those of scalar functions are.
        """
        if null_handling not in ("default", "special"):
            raise ValueError("null_handling is default or special")
        if not args:
            raise ValueError("an aggregate has an argument at least")
        calls = agg.Callbacks(**callbacks)
        chosen, kind = [normalize(x) for x in args], normalize(returns)
        spec = Registration(name, "aggregate", chosen, kind, self._plan, {"null_handling": null_handling, "calls": calls})
        self._made[f"{name}_rows"] = _of_lists(spec, calls)
        self.spark.udf.register(f"{name}_rows", self._made[f"{name}_rows"])
        return self._keep(spec, _grouped(spec, calls))

    def agg(self, name: str, *columns: Column | str, where: Column | None = None, distinct: bool = False) -> Column:
        """The aggregate as a Column, for groups that fit in a row of arguments; ``where`` and ``distinct`` as in SQL."""
        spec = self._find(name, "aggregate")
        given = [F.col(x) if isinstance(x, str) else x for x in columns]
        return agg.expression(spec.options["calls"], spec.args, spec.returns, spec.options["null_handling"] == "special", given, where, distinct)

    def aggregate(self, df: DataFrame, keys: list[str], name: str, *columns: Column | str, alias: str | None = None, where: Column | None = None, distinct: bool = False, sets: list[list[str]] | None = None) -> DataFrame:
        """The aggregate for each key, by partial states; for groups of any size. Needs combine.

        ``where`` as FILTER and ``distinct`` as DISTINCT in SQL; ``sets`` are grouping sets of the keys, to which each row is dealt.
        """
        spec = self._find(name, "aggregate")
        given = [F.col(x) if isinstance(x, str) else x for x in columns]
        special = spec.options["null_handling"] == "special"
        if sets is None:
            return agg.aggregate(spec.options["calls"], spec.args, spec.returns, special, df, keys, given, alias or name, where=where, distinct=distinct)
        plain = df.select(*keys, *(c.alias(f"_x{i}") for i, c in enumerate(given)), (F.lit(True) if where is None else where).alias("_x"), F.explode(F.array(*map(F.lit, range(len(sets))))).alias("_set"))
        dealt = plain.select("_set", *(F.when(F.col("_set").isin([i for i, x in enumerate(sets) if k in x]), F.col(k)).alias(k) for k in keys), *(f"_x{i}" for i in range(len(given))), "_x")
        found = agg.aggregate(spec.options["calls"], spec.args, spec.returns, special, dealt, ["_set", *keys], [F.col(f"_x{i}") for i in range(len(given))], alias or name, where=F.col("_x"), distinct=distinct)
        return found.drop("_set")

    def window(self, df: DataFrame, name: str, *columns: Column | str, partition: list[str], order: list[str | Column], rows: tuple[int, int], alias: str | None = None) -> DataFrame:
        """df with the aggregate over each row's frame: ROWS from ``rows[0]`` to ``rows[1]``, both counted from the row, in its partition.

        For partitions of any number and size; the SQL name and ``over()`` take Spark's way, with a call and a slice of columns for each row.
        """
        spec = self._find(name, "aggregate")
        given = [F.col(x) if isinstance(x, str) else x for x in columns]
        return agg.window(spec.options["calls"], spec.args, spec.returns, spec.options["null_handling"] == "special", df, partition, order, given, alias or name, rows)

    def register_table(self, name: str, fun: Callable, chunk_size: int = 1024) -> Registration:
        """A table function, of SQL and of table(). fun returns columns (dict, Arrow table, pandas frame) or a TableStream."""
        if not 1 <= chunk_size <= table.MOST_ROWS:
            raise ValueError(f"chunk_size is 1 to {table.MOST_ROWS}")
        table.arity(fun)
        self._size(fun)
        spec = Registration(name, "table", None, None, self._plan, {"chunk_size": chunk_size, "parameters": list(inspect.signature(fun).parameters), "function": fun})
        return self._keep(spec, table.sql_function(fun, chunk_size))

    def table(self, name: str, *args: Any) -> DataFrame:
        """The table of a call, made lazily and in parts if it is a stream."""
        spec = self._find(name, "table")
        return table.frame(self.spark, spec.options["function"], args, spec.options["chunk_size"])

    def bind(self, returns: dict[str, LType | str], null_handling: str = "default", exception_handling: str = "rethrow", side_effects: bool = False, mode: str = "scalar", **helpers: Callable) -> Bridge:
        """Helpers as functions of columns, within a ``with`` block."""
        return Bridge(self, returns, helpers, null_handling=null_handling, exception_handling=exception_handling, side_effects=side_effects, mode=mode)

    def query_stream(self, query: str | DataFrame, batch_rows: int = 2048) -> QueryStream:
        """A result in batches. Temporary views of the session can be used; several streams can be open."""
        out = QueryStream(self.spark.sql(query) if isinstance(query, str) else query, batch_rows)
        self._streams = [x for x in self._streams if x._rows is not None] + [out]
        return out

    # -- what is known

    def explain(self, name: str) -> dict[str, Any]:
        """What a function was registered with, and counts of its use (of at least so many)."""
        if name not in self._known:
            raise NameError(f"no function {name!r}")
        found = self._known[name].explained()
        return {k: v for k, v in found.items() if k not in ("calls_", "function")}

    def list(self, kind: str = "scalar") -> list[dict[str, Any]]:
        return [self.explain(x.name) for x in sorted(self._known.values(), key=lambda x: x.name) if x.kind == kind]

    def reset_counters(self, name: str | None = None) -> None:
        for x in self._known.values():
            if name in (None, x.name):
                for counter in x.counters.values():
                    counter.value = 0

    def stats(self) -> dict[str, int]:
        return {"functions": len(self._known), "open_streams": sum(x._rows is not None for x in self._streams), "active_jobs": len(self.spark.sparkContext.statusTracker().getActiveJobsIds())}

    def self_test(self, n: int = 1000) -> dict[str, int]:
        """Sends n rows through each plan and counts what did not come back as it was."""
        out, before = {}, self._plan
        for name in ("reference", "pickled", "arrow"):
            self.set_plan(name)
            made = self.register_scalar(f"self_test_{name}", lambda x: x, args=["i64"], returns="i64")
            out[name] = self.spark.range(n).where(~made.udf("id").eqNullSafe(F.col("id"))).count()
        self.set_plan(before)
        return out


def _grouped(spec: Registration, calls: agg.Callbacks) -> Any:
    """The aggregate under its SQL name: a whole group's columns in a task."""
    import pyarrow as pa

    from .functions.values import checker
    from .operators.scalar import _arrow

    read, check, special = agg._read(spec.args), checker(spec.returns), spec.options["null_handling"] == "special"
    stored = _arrow(spec.returns)

    def whole(*columns: pa.Array) -> Any:
        rows = [read(r) for r in zip(*(x.to_pylist() for x in columns)) if special or None not in r]
        state = calls.folded([None], [1] * len(rows), rows)[0] if rows else None
        return pa.scalar(check(calls.finished([state])[0]), stored)

    return F.arrow_udf(whole, spec.returns.spark, F.ArrowUDFType.GROUPED_AGG)


def _of_lists(spec: Registration, calls: agg.Callbacks) -> Any:
    """The aggregate of each list of arguments (structs, if there are several), a batch of lists at a time."""
    import pyarrow as pa

    from .functions.values import checker
    from .operators.scalar import _arrow, _typed

    args, read, check, special = spec.args, agg._read(spec.args), checker(spec.returns), spec.options["null_handling"] == "special"
    stored = _arrow(spec.returns)

    def each(lists):
        flat = lists.flatten()
        columns = _typed(tuple(flat.flatten()) if len(args) > 1 else (flat,), args)
        rows = list(zip(*(x.to_pylist() for x in columns)))
        used = [special or None not in r for r in rows]
        sizes = lists.value_lengths().fill_null(0).to_pylist()
        groups = [k if u else 0 for u, k in zip(used, (k for k, n in enumerate(sizes, 1) for _ in range(n)))]
        states = calls.folded([None] * len(lists), groups, [read(r) if u else r for u, r in zip(used, rows)]) if rows else [None] * len(lists)
        return pa.array([check(x) for x in calls.finished(states)], stored)

    return F.arrow_udf(each, spec.returns.spark, F.ArrowUDFType.SCALAR)
