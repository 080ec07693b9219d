"""Scalar functions: rows or columns at a time, with strict results and explicit policies for NULL and errors."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from decimal import Decimal
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.values import checker, reader, whole
from ..plans.registry import Registration
from ..types import BLOB, INTEGERS, LType

#: Kinds whose batches are checked as a whole, by a cast that refuses to lose anything.
_BULK = frozenset(["bool", "i8", "i16", "i32", "i64", "f32", "f64", "varchar", "blob", "date", "time", "timestamp"])


def _arrow(kind: LType) -> pa.DataType:
    return to_arrow_type(kind.spark)


def _fits(given: pa.DataType, want: pa.DataType, kind: LType) -> bool:
    """Whether SQL turns such a column into an argument of that type unasked: numbers into wider kinds, never text into numbers."""
    is_text = lambda x: pa.types.is_string(x) or pa.types.is_large_string(x)
    number = pa.types.is_integer(given) or pa.types.is_decimal(given)
    if kind.name in ("hugeint", "uhugeint") and kind.kind == "scalar":
        return pa.types.is_integer(given) or is_text(given)
    if pa.types.is_floating(want):
        return number or pa.types.is_floating(given)
    if pa.types.is_decimal(want) or pa.types.is_integer(want):
        return number
    if pa.types.is_timestamp(want):
        return pa.types.is_timestamp(given) or pa.types.is_date(given)
    if pa.types.is_nested(want):
        return type(given) is type(want)
    return given == want or is_text(given) and is_text(want)


def _typed(columns: tuple[pa.Array, ...], args: list[LType] | None) -> tuple[pa.Array, ...]:
    """Columns of the declared types: cast where SQL would cast unasked, refused elsewhere."""
    if args is None:
        _concrete(columns)
        return columns
    if len(columns) != len(args):
        raise TypeError(f"{len(args)} arguments, not {len(columns)}")
    out = []
    for i, (x, kind) in enumerate(zip(columns, args), 1):
        want = _arrow(kind)
        if x.type != want and not pa.types.is_null(x.type):
            if not _fits(x.type, want, kind):
                raise TypeError(f"argument {i} is {x.type}, not {kind.sql}")
            if pa.types.is_timestamp(x.type) and x.type.tz:
                x = pc.local_timestamp(x)
        try:
            x = x.cast(want, safe=not pa.types.is_floating(want))
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as e:
            raise TypeError(f"argument {i} is no {kind.sql}: {e}") from e
        if kind.kind == "scalar" and kind.name in ("u8", "u16", "u32", "u64") and len(x) > x.null_count:
            low, high = pc.min_max(x).as_py().values()
            whole(int(low), kind)
            whole(int(high), kind)
        out.append(x)
    return tuple(out)


#: What values of a kind are in rows of Spark.
_IN_ROWS = {"list": list, "array": list, "map": dict, "varchar": str, "bool": bool, "blob": (bytes, bytearray), "geometry": (bytes, bytearray), "date": dt.date, "timestamp": dt.datetime, "time": dt.time, "uuid": str}


def _argument(kind: LType, i: int) -> Callable[[Any], Any]:
    """The check of one value of a row, for plans that know no columns; and its form for the function."""
    read = reader(kind)
    plain = kind.kind == "scalar" and kind.name in INTEGERS and kind.name not in ("hugeint", "uhugeint")
    real = kind.kind == "scalar" and kind.name in ("f32", "f64")
    classes = _IN_ROWS.get(kind.name if kind.kind == "scalar" else kind.kind)

    def take(x: Any) -> Any:
        if x is None:
            return None
        if plain or real:
            if isinstance(x, bool) or not isinstance(x, (int, Decimal, float) if real else (int, Decimal)):
                raise TypeError(f"argument {i} is {type(x).__name__}, not {kind.sql}")
            x = float(x) if real else whole(int(x) if x == int(x) else x, kind)
        elif classes and not isinstance(x, classes) or kind.name == "date" and isinstance(x, dt.datetime):
            raise TypeError(f"argument {i} is {type(x).__name__}, not {kind.sql}")
        return read(x) if read else x

    return take


def _row_call(fun: Callable, spec: Registration, counts: dict, typed: bool = False) -> Callable[..., Any]:
    """One row: types of arguments (unless its columns were ``typed``), NULL policy, the call under the error policy, the check of the result outside it."""
    check, default = checker(spec.returns), spec.options["null_handling"] == "default"
    quiet = spec.options["exception_handling"] == "return_null"
    readers = None if spec.args is None else [reader(x) if typed else _argument(x, i) for i, x in enumerate(spec.args, 1)]

    def call(*args: Any) -> Any:
        if readers is not None and len(args) != len(readers):
            raise TypeError(f"{len(readers)} arguments, not {len(args)}")
        if default and any(x is None for x in args):
            counts["null_skips"].add(1)
            return None
        counts["calls"].add(1)
        if readers is not None:
            args = tuple(f(x) if f else x for f, x in zip(readers, args, strict=True))
        try:
            value = fun(*args)
        except Exception:
            if not quiet:
                raise
            counts["errors_to_null"].add(1)
            return None
        return check(value)

    return call


class _Tally:
    """Counts within a batch, added to the accumulators once."""

    def __init__(self):
        self.n = 0

    def add(self, n: int) -> None:
        self.n += n


def _concrete(columns: tuple[pa.Array, ...]) -> None:
    if any(pa.types.is_null(x.type) for x in columns):
        raise TypeError("arguments must have concrete types; cast the NULL")


def _rows_of_batch(fun: Callable, spec: Registration, counts: dict) -> Callable[..., pa.Array]:
    arrow = _arrow(spec.returns)

    def batch(*columns: pa.Array) -> pa.Array:
        columns = _typed(columns, spec.args)
        tally = {k: _Tally() for k in counts}
        call = _row_call(fun, spec, tally, typed=True)
        values = [call(*row) for row in zip(*(x.to_pylist() for x in columns))]
        counts["batches"].add(1)
        counts["rows"].add(len(columns[0]))
        for k, x in tally.items():
            if x.n:
                counts[k].add(x.n)
        return pa.array(values, arrow)

    return batch


def _column(value: Any, kind: LType, n: int) -> pa.Array:
    """What a vectorized function returned, as an array of n values of the type."""
    arrow = _arrow(kind)
    if value is None:
        return pa.nulls(n, arrow)
    if isinstance(value, pa.ChunkedArray):
        value = value.combine_chunks()
    if kind.kind == "struct" and not isinstance(value, (pa.Array, list, tuple)):
        table = value if isinstance(value, pa.Table) else pa.Table.from_pandas(value, preserve_index=False)
        value = table.to_pylist()
    if kind.kind == "scalar" and kind.name in _BULK:
        if not isinstance(value, pa.Array):
            value = pa.array(value, from_pandas=type(value).__module__.startswith("pandas") and kind.name not in ("f32", "f64"))
        if (pa.types.is_boolean(value.type) or pa.types.is_string(value.type)) and not pa.types.is_null(value.type) and value.type != arrow:
            raise TypeError(f"a column of {value.type} is no {kind.sql}")
        if pa.types.is_timestamp(value.type) and not pa.types.is_timestamp(arrow):
            raise TypeError(f"a column of {value.type} is no {kind.sql}")
        out = value.cast(arrow, safe=kind.name != "f32")
    else:
        check = checker(kind)
        out = pa.array([check(x) for x in (value.to_pylist() if isinstance(value, pa.Array) else value)], arrow)
    if len(out) != n:
        raise ValueError(f"a vectorized function got {n} rows and returned {len(out)}")
    return out


def _columns(fun: Callable, spec: Registration, counts: dict) -> Callable[..., pa.Array]:
    """A batch: rows with a NULL are taken out before the call and put back after it."""
    default, quiet = spec.options["null_handling"] == "default", spec.options["exception_handling"] == "return_null"
    arrow = _arrow(spec.returns)

    def batch(*columns: pa.Array) -> pa.Array:
        columns = _typed(columns, spec.args)
        n = len(columns[0])
        counts["batches"].add(1)
        counts["rows"].add(n)
        valid = None
        if default and any(x.null_count for x in columns):
            valid = columns[0].is_valid()
            for x in columns[1:]:
                valid = pc.and_(valid, x.is_valid())
            columns = tuple(x.filter(valid) for x in columns)
            counts["null_skips"].add(n - len(columns[0]))
        rows = len(columns[0])
        if not rows and n:
            return pa.nulls(n, arrow)
        counts["calls"].add(1)
        try:
            value = fun(*columns)
        except Exception:
            if not quiet:
                raise
            counts["errors_to_null"].add(rows)
            value = None
        out = _column(value, spec.returns, rows)
        if valid is None:
            return out
        places = pc.subtract(pc.cumulative_sum(valid.cast(pa.int64())), 1)
        return out.take(pc.if_else(valid, places, pa.scalar(None, pa.int64())))

    return batch


def _variant(kind: LType | None) -> bool:
    return kind is not None and (kind.name == "variant" or any(map(_variant, kind.children)))


def evaluator(fun: Callable, spec: Registration, counts: dict) -> Any:
    """The Spark function of a registration. Rows of VARIANT, and calls without arguments, go one by one under each plan."""
    spec = replace(spec, udf=None, counters={})  # what tasks get refers to no session
    mode, returns = spec.options["mode"], spec.returns.spark
    if mode == "vectorized":
        made = F.arrow_udf(_any_arity(_columns(fun, spec, counts)), returnType=returns)
    elif spec.plan.name == "arrow" and spec.args != [] and not _variant(spec.returns) and not any(map(_variant, spec.args or [])):
        made = F.arrow_udf(_any_arity(_rows_of_batch(fun, spec, counts)), returnType=returns)
    else:
        call = _row_call(fun, spec, counts)
        as_row = _to_row(returns)

        def row(*args: Any) -> Any:
            counts["rows"].add(1)
            return as_row(call(*args))

        made = F.udf(row, returns)
    return made.asNondeterministic() if spec.options["side_effects"] else made


def _any_arity(f: Callable[..., pa.Array]) -> Callable[..., pa.Array]:
    def batch(*columns: pa.Array) -> pa.Array:
        return f(*columns)

    return batch


def _to_row(kind: T.DataType) -> Callable[[Any], Any]:
    """Checked structs as rows of Spark, which takes dicts for maps."""
    if isinstance(kind, T.StructType):
        inner = [_to_row(x.dataType) for x in kind]
        return lambda x: None if x is None else tuple(f(x[n]) for f, n in zip(inner, kind.names))
    if isinstance(kind, T.ArrayType):
        one = _to_row(kind.elementType)
        return lambda x: None if x is None else [one(v) for v in x]
    if isinstance(kind, T.MapType):
        one = _to_row(kind.valueType)
        return lambda x: None if x is None else {k: one(v) for k, v in x.items()}
    return lambda x: bytearray(x) if isinstance(x, bytes) and kind == BLOB.spark else x
