"""Table functions: Python that makes a table, whole or batch by batch."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

#: Arguments that a table function may have, and rows of a batch.
MOST_ARGS, MOST_ROWS = 64, 1024


@dataclass(frozen=True)
class TableStream:
    """A table that is made batch by batch, on executors.

    prototype: a table with the columns (rows do not matter). next_batch(n), or next_batch(), gives
    the next rows, of any number but none, and None at the end. close() is called once, at the end
    or when the query needs no more. exact: cardinality is what it must come to. open(part, parts)
    may stand in for next_batch and close: it is called in each of ``parts`` tasks and gives both
    for that part, so that a large table is made by many.
    """

    prototype: Any
    next_batch: Callable | None = None
    close: Callable[[], None] | None = None
    cardinality: int | None = None
    exact: bool = False
    open: Callable[[int, int], tuple[Callable, Callable | None]] | None = None
    parts: int = 1

    def __post_init__(self) -> None:
        if (self.next_batch is None) == (self.open is None):
            raise ValueError("a table stream has next_batch or open")
        if self.parts != 1 and self.open is None:
            raise ValueError("several parts need open")
        if self.exact and (self.cardinality is None or self.parts != 1):
            raise ValueError("exact needs a cardinality and one part")


#: Kinds of columns that a table may have.
_KINDS = (pa.types.is_boolean, pa.types.is_integer, pa.types.is_floating, pa.types.is_string, pa.types.is_large_string, pa.types.is_binary, pa.types.is_date, pa.types.is_timestamp, pa.types.is_decimal, pa.types.is_list, pa.types.is_struct, pa.types.is_dictionary)


def as_table(value: Any) -> pa.Table:
    """A table of named columns of one length; else an error."""
    if isinstance(value, pa.RecordBatch):
        value = pa.Table.from_batches([value])
    if isinstance(value, dict):
        if len({len(x) for x in value.values()}) > 1:
            raise ValueError("the columns of a table have one length")
        value = pa.table(value) if value else None
    elif value is not None and not isinstance(value, pa.Table):
        value = pa.Table.from_pandas(value, preserve_index=False)
    if value is None or not value.num_columns:
        raise ValueError("a table has a column at least")
    names = value.column_names
    if not all(names) or len(set(names)) < len(names):
        raise ValueError("the columns of a table have distinct names that are not empty")
    for field in value.schema:
        if not any(is_kind(field.type) for is_kind in _KINDS):
            raise TypeError(f"column {field.name}: {field.type} has no SQL type here")
    fields = [pa.field(f.name, pa.string() if pa.types.is_dictionary(f.type) or pa.types.is_large_string(f.type) else f.type) for f in value.schema]
    return value.cast(pa.schema(fields))


def _same(batch: pa.Table, schema: pa.Schema) -> pa.Table:
    if batch.column_names != schema.names:
        raise TypeError(f"a batch has the columns {batch.column_names}, the prototype {schema.names}")
    for a, b in zip(batch.schema, schema):
        if a.type != b.type and not pa.types.is_null(a.type):
            raise TypeError(f"column {a.name} of a batch is {a.type}, of the prototype {b.type}")
    return batch.cast(schema)


def _pulled(stream: TableStream, schema: pa.Schema, n: int, part: int) -> Iterator[pa.RecordBatch]:
    """A part's batches, of n rows at most."""
    pull, close = stream.open(part, stream.parts) if stream.open else (stream.next_batch, stream.close)
    takes = bool(inspect.signature(pull).parameters)
    rows = 0
    try:
        while (found := pull(n) if takes else pull()) is not None:
            batch = _same(as_table(found), schema)
            if not batch.num_rows:
                raise ValueError("a batch has a row at least; None is the end")
            rows += batch.num_rows
            if stream.exact and rows > stream.cardinality:
                raise ValueError(f"more rows than the {stream.cardinality} promised")
            yield from batch.combine_chunks().to_batches(max_chunksize=n)
        if stream.exact and rows < stream.cardinality:
            raise ValueError(f"{rows} rows, not the {stream.cardinality} promised")
    finally:
        if close:
            close()


def arity(fun: Callable) -> int:
    found = list(inspect.signature(fun).parameters.values())
    if any(x.kind in (x.VAR_POSITIONAL, x.VAR_KEYWORD) for x in found) or len(found) > MOST_ARGS:
        raise ValueError(f"a table function has {MOST_ARGS} named arguments at most")
    return len(found)


def frame(spark: SparkSession, fun: Callable, args: tuple, chunk_size: int) -> DataFrame:
    """The table of fun(*args), which is called once, here. A finite table is a local relation; a stream is made in tasks, lazily."""
    if len(args) != arity(fun):
        raise TypeError(f"{arity(fun)} arguments, not {len(args)}")
    made = fun(*args)
    if not isinstance(made, TableStream):
        return spark.createDataFrame(as_table(made))
    schema = as_table(made.prototype).schema

    def produce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (x for b in batches for x in b.column(0).to_pylist()):
            yield from _pulled(made, schema, chunk_size, part)

    return spark.range(0, made.parts, 1, made.parts).mapInArrow(produce, from_arrow_schema(schema))


@dataclass
class _Bound(AnalyzeResult):
    """What binding made, for the scan: the rows of a finite table, or the arguments of a stream."""

    rows: list | None = None


def sql_function(fun: Callable, chunk_size: int) -> Any:
    """fun as a table function of SQL: called once, when a query is bound, with the values of its constant arguments."""
    n = arity(fun)

    class Function:
        def __init__(self, bound: _Bound):
            self.bound = bound

        @staticmethod
        def analyze(*args: AnalyzeArgument) -> _Bound:
            if len(args) != n:
                raise TypeError(f"{n} arguments, not {len(args)}")
            if not all(x.isConstantExpression for x in args):
                raise TypeError("the arguments of a table function are constants")
            made = fun(*(x.value for x in args))
            stream = isinstance(made, TableStream)
            table = as_table(made.prototype if stream else made)
            return _Bound(schema=from_arrow_schema(table.schema), rows=None if stream else [tuple(x.values()) for x in table.to_pylist()])

        def eval(self, *args: Any) -> Iterator[tuple]:
            if self.bound.rows is not None:
                yield from self.bound.rows
                return
            made = fun(*args)
            schema = as_table(made.prototype).schema
            for part in range(made.parts):
                for batch in _pulled(made, schema, chunk_size, part):
                    yield from (tuple(x.values()) for x in batch.to_pylist())

    return F.udtf(Function)
