"""Aggregates with any Python object as state.

Three lowerings. ``aggregate()`` has partial states: each task folds its own rows into a state for
each of its keys, only states are shuffled, and combine() merges them; a key with a third of all
rows is then one state for each task. ``expression()`` is a Column for use among other aggregates,
FILTER, DISTINCT, ROLLUP and windows: it gathers a group's arguments in one row, so it is for groups
that fit there. ``window()`` is for frames of rows: partitions are sorted, and a task holds the rows
of a frame.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import checker, reader
from ..types import LType


@dataclass(frozen=True)
class Callbacks:
    """What an aggregate does; a chunk form is used where there is one.

    update(state, *args) -> state; finalize(state) -> value; combine(left, right) -> state;
    copy(state) -> state. update_chunk(states, group_ids, *columns) -> states: group_ids are 1-based
    places in states, 0 for rows that are left out. combine_chunk(lefts, rights) -> states,
    finalize_chunk(states) -> values and copy_chunk(states) -> states are lists in, lists out. A
    state is None until something was added.
    """

    update: Callable | None = None
    finalize: Callable | None = None
    combine: Callable | None = None
    copy: Callable | None = None
    update_chunk: Callable | None = None
    finalize_chunk: Callable | None = None
    combine_chunk: Callable | None = None
    copy_chunk: Callable | None = None

    def __post_init__(self) -> None:
        if not (self.update or self.update_chunk) or not (self.finalize or self.finalize_chunk):
            raise ValueError("an aggregate needs update or update_chunk, and finalize or finalize_chunk")

    @property
    def merges(self) -> bool:
        return bool(self.combine or self.combine_chunk)

    def _phase(self, phase: str, fun: Callable, *args: Any) -> Any:
        try:
            return fun(*args)
        except Exception as e:
            raise RuntimeError(f"aggregate {phase}: {e}") from e

    def _list(self, phase: str, fun: Callable, n: int, *args: Any) -> list:
        out = list(self._phase(phase, fun, *args))
        if len(out) != n:
            raise RuntimeError(f"aggregate {phase}: {n} states in, {len(out)} out")
        return out

    def folded(self, states: list, groups: list[int], rows: list[tuple]) -> list:
        """states with the rows added; groups has each row's place, 1-based, or 0."""
        if self.update_chunk:
            return self._list("update", self.update_chunk, len(states), states, groups, *map(list, zip(*rows)))
        for k, row in zip(groups, rows):
            if k:
                states[k - 1] = self._phase("update", self.update, states[k - 1], *row)
        return states

    def merged(self, left: Any, right: Any) -> Any:
        """Of two partial states; an empty one leaves the other, copied."""
        if right is None or left is None:
            state = left if right is None else right
            if state is None:
                return None
            if self.copy_chunk:
                return self._list("copy", self.copy_chunk, 1, [state])[0]
            return self._phase("copy", self.copy, state) if self.copy else state
        if self.combine_chunk:
            return self._list("combine", self.combine_chunk, 1, [left], [right])[0]
        return self._phase("combine", self.combine, left, right)

    def finished(self, states: list) -> list:
        if self.finalize_chunk:
            out = self._phase("finalize", self.finalize_chunk, states)
            if out is None and len(states) == 1:
                return [None]
            return self._list("finalize", lambda x: x, len(states), out)
        return [self._phase("finalize", self.finalize, x) for x in states]


def _read(args: list[LType]) -> Callable[[tuple], tuple]:
    readers = [reader(x) for x in args]
    return lambda row: tuple(f(x) if f else x for f, x in zip(readers, row, strict=True))


def expression(calls: Callbacks, args: list[LType], returns: LType, special: bool, columns: list[Column], where: Column | None = None, distinct: bool = False) -> Column:
    """The aggregate as a Column, for agg() and over(). A group without rows is finalized all the same."""
    read, check = _read(args), checker(returns)

    from .scalar import _to_row

    as_row = _to_row(returns.spark)

    def finish(rows: list) -> Any:
        own = [read(tuple(r)) for r in rows or []]
        state = calls.folded([None], [1] * len(own), own)[0] if own else None
        return as_row(check(calls.finished([state])[0]))

    packed = F.struct(*(c.cast(a.spark).alias(f"_{i}") for i, (c, a) in enumerate(zip(columns, args, strict=True))))
    usable = where
    if not special:
        for c in columns:
            usable = c.isNotNull() if usable is None else usable & c.isNotNull()
    gathered = packed if usable is None else F.when(usable, packed)
    return F.udf(finish, returns.spark)((F.collect_set if distinct else F.collect_list)(gathered))


def _has_fractions(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_fractions(f.dataType) for f in kind)
    return isinstance(kind, (T.FloatType, T.DoubleType)) or isinstance(kind, T.ArrayType) and _has_fractions(kind.elementType)


def _one_zero(x: Column, kind: T.DataType) -> Column:
    """A key as GROUP BY sees it: -0.0 is 0.0, and there is one NaN."""
    if not _has_fractions(kind):
        return x
    if isinstance(kind, T.ArrayType):
        return F.transform(x, lambda v: _one_zero(v, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(x.isNotNull(), F.struct(*(_one_zero(x[f.name], f.dataType).alias(f.name) for f in kind)))
    return F.when(x == 0, F.lit(0.0).cast(kind)).when(F.isnan(x), F.lit(float("nan")).cast(kind)).otherwise(x)


def _frozen(x: Any) -> Any:
    """A key's value as one that can be looked up, with NaN equal to itself."""
    if isinstance(x, list):
        return tuple(map(_frozen, x))
    if isinstance(x, dict):
        return tuple((k, _frozen(v)) for k, v in x.items())
    return ("NaN",) if x != x else x


def _hashed(column: pa.Array, values: list) -> list:
    kind = column.type
    return list(map(_frozen, values)) if pa.types.is_nested(kind) or pa.types.is_floating(kind) else values


def aggregate(calls: Callbacks, args: list[LType], returns: LType, special: bool, df: DataFrame, keys: list[str], columns: list[Column], name: str, most_keys: int = 50_000, where: Column | None = None, distinct: bool = False) -> DataFrame:
    """A row for each key, with the aggregate as ``name``, by partial states (combine is needed).

    A task keeps ``most_keys`` states at most and passes them on when there are more. Without keys
    there is one row, also for an empty table. Keys are equal where GROUP BY has them equal: NaN to
    NaN, -0.0 to 0.0, arrays and structs by their parts (maps are no keys). Rows that fail ``where`` are left out; their keys
    stay. ``distinct``: of rows with equal keys and arguments one counts, found by a shuffle with partial sums.
    """
    if not calls.merges:
        raise ValueError("partial aggregation needs combine or combine_chunk; agg() does without")
    read, n = _read(args), len(keys)
    df = df.withColumns({k: _one_zero(F.col(k), df.schema[k].dataType) for k in keys if _has_fractions(df.schema[k].dataType)})
    chosen = df.select(*keys, *(c.cast(a.spark).alias(f"_a{i}") for i, (c, a) in enumerate(zip(columns, args, strict=True))), (F.lit(True) if where is None else F.coalesce(where, F.lit(False))).alias("_w"))
    schema = T.StructType([*(chosen.schema[k] for k in keys), T.StructField("_state", T.BinaryType())])
    if distinct:
        chosen = chosen.distinct()
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[tuple, int] = {}
        own: list[tuple] = []  # the key of each state
        states: list = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*own)) if n else []
            return pa.RecordBatch.from_arrays([*(pa.array(x, t.type) for x, t in zip(columns, arrow)), pa.array([pickle.dumps(x) for x in states], pa.binary())], schema=arrow)

        for batch in batches:
            raw = [x.to_pylist() for x in batch.columns]
            if not batch.num_rows:
                continue
            keyed = list(zip(*map(_hashed, batch.columns[:n], raw))) if n else [()] * batch.num_rows
            plain = list(zip(*raw[:n])) if n else keyed
            rows = list(zip(*raw[n:-1]))
            groups = []
            for i, (key, row, used) in enumerate(zip(keyed, rows, raw[-1])):
                place = places.setdefault(key, len(places))
                if place == len(own):
                    own.append(plain[i])
                groups.append(0 if not used or not special and any(x is None for x in row) else place + 1)
            states += [None] * (len(places) - len(states))
            states = calls.folded(states, groups, [read(r) if g else r for r, g in zip(rows, groups)])
            if len(places) > most_keys:
                yield out()
                places.clear()
                own.clear()
                states = []
        if places:
            yield out()

    check = checker(returns)
    result = T.StructType([*(chosen.schema[k] for k in keys), T.StructField(name, returns.spark)])
    arrow_result = to_arrow_schema(result)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows are sorted by key, so that one state is held at a time."""
        held: list = []  # of each key: its hashed form, the key, the state

        def out(done: list) -> pa.RecordBatch:
            values = [check(x) for x in calls.finished([s for *_, s in done])]
            columns = list(zip(*(k for _, k, _ in done))) if n else []
            return pa.RecordBatch.from_arrays([*(pa.array(x, t.type) for x, t in zip(columns, arrow_result)), pa.array(values, arrow_result.field(n).type)], schema=arrow_result)

        for batch in batches:
            *raw, found = (x.to_pylist() for x in batch.columns)
            keyed = zip(*map(_hashed, batch.columns, raw)) if n else [()] * batch.num_rows
            plain = zip(*raw) if n else [()] * batch.num_rows
            for same, key, state in zip(keyed, plain, found):
                if held and held[-1][0] == same:
                    held[-1][2] = calls.merged(held[-1][2], pickle.loads(state))
                else:
                    held.append([same, key, calls.merged(None, pickle.loads(state))])
            if len(held) > 1000:
                yield out(held[:-1])
                del held[:-1]
        if held:
            yield out(held)

    states = chosen.mapInArrow(partial, schema)
    if n:
        shuffled = states.repartition(*(F.col(k) for k in keys)).sortWithinPartitions(*keys)
        return shuffled.mapInArrow(final, result)
    nothing = df.sparkSession.createDataFrame([(pickle.dumps(None),)], schema)
    return states.unionByName(nothing).repartition(1).mapInArrow(final, result)  # of the states: what is before it keeps its tasks


def window(calls: Callbacks, args: list[LType], returns: LType, special: bool, df: DataFrame, partition: list[str], order: list[str | Column], columns: list[Column], name: str, rows: tuple[int, int]) -> DataFrame:
    """df with the aggregate of each row's frame as ``name``: the rows from rows[0] to rows[1] places after it, in order.

    Partitions are equal where GROUP BY has keys equal. Rows are dealt by partition and sorted, and each task goes
    over its rows once; it holds the rows of a frame and a batch, however large a partition is.
    """
    low, high = rows
    if low > high:
        raise ValueError("a frame begins before it ends")
    if not partition:
        raise ValueError("a window has a partition column at least")
    from pyspark.sql.pandas.types import to_arrow_schema

    read, check, n, m = _read(args), checker(returns), len(df.columns), len(partition)
    keys = {f"_k{i}": _one_zero(F.col(k), df.schema[k].dataType) for i, k in enumerate(partition)}
    given = {f"_a{i}": c.cast(a.spark) for i, (c, a) in enumerate(zip(columns, args, strict=True))}
    dealt = df.withColumns(keys | given).repartition(*keys).sortWithinPartitions(*keys, *order)
    result = T.StructType([*df.schema, T.StructField(name, returns.spark)])
    arrow = to_arrow_schema(result)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []  # their rows are in held, or done
        held: list[tuple] = []  # (number of the partition, arguments or None if left out)
        values: list = []  # of rows of the waiting batches
        at, partitions, last = 0, 0, None  # held[at] is the next row

        def moved(end: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, at
            stop = len(held) if end else max(at, len(held) - max(high, 0))
            states = []
            for i in range(at, stop):
                own = held[i][0]
                frame = [x[1] for x in held[max(0, i + low) : max(0, i + high + 1)] if x[0] == own and x[1] is not None]
                states.append(calls.folded([None], [1] * len(frame), frame)[0] if frame else None)
            if states:
                values.extend(map(check, calls.finished(states)))
            keep = max(0, stop + min(low, 0))
            held, at = held[keep:], stop - keep
            while waiting and len(values) >= waiting[0].num_rows:
                batch = waiting.pop(0)
                mine, values[:] = values[: batch.num_rows], values[batch.num_rows :]
                yield pa.RecordBatch.from_arrays([*(x.cast(f.type) for x, f in zip(batch.columns[:n], arrow)), pa.array(mine, arrow.field(n).type)], schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.columns[n : n + m]
            for key, row in zip(zip(*(_hashed(x, x.to_pylist()) for x in own)), zip(*(x.to_pylist() for x in batch.columns[n + m :]))):
                if key != last:
                    partitions, last = partitions + 1, key
                held.append((partitions, None if not special and None in row else read(row)))
            waiting.append(batch)
            yield from moved(False)
        yield from moved(True)

    return dealt.mapInArrow(frames, result)
