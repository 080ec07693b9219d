"""Query results in batches, with one partition at a time in the driver; and user functions over streams of files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch as bytes."""
    for batch in batches:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["batch"])


class QueryStream:
    """Batches of a query's result: next_batch() gives a table, or None at the end and after close().

    Rows come to the driver in columns, a partition at a time, the next one while this one is read.
    Size partitions, not the result, to the driver's memory.
    """

    def __init__(self, df: DataFrame, batch_rows: int = 2048):
        if batch_rows < 1:
            raise ValueError("a batch has a row at least")
        self.df, self.batch_rows = df, batch_rows
        self.schema = [(f.name, f.dataType.simpleString()) for f in df.schema]
        self._arrow = to_arrow_schema(df.schema)
        self._context, self._tag = df.sparkSession.sparkContext, f"query-stream-{uuid.uuid4().hex}"
        self._context.addJobTag(self._tag)
        try:
            packed = df.toDF(*map(str, range(len(df.columns)))).mapInArrow(_packed, "batch binary")
            self._rows: Iterator | None = packed.toLocalIterator(prefetchPartitions=True)
        finally:
            self._context.removeJobTag(self._tag)
        self._left: pa.Table | None = None
        self._pulling = False

    def __repr__(self) -> str:
        return f"<query stream {', '.join(f'{n} {t}' for n, t in self.schema)}{'' if self._rows else '; closed'}>"

    def next_batch(self) -> pa.Table | None:
        if self._rows is None:
            return None
        if self._pulling:
            raise RuntimeError("next_batch() is already under way")
        self._pulling = True
        try:
            found, n = [self._left] if self._left else [], self._left.num_rows if self._left else 0
            while n < self.batch_rows and (row := next(self._rows, None)) is not None:
                found.append(pa.ipc.open_stream(row["batch"]).read_all())
                n += found[-1].num_rows
        finally:
            self._pulling = False
        if not n:
            self.close()
            return None
        whole = pa.concat_tables(found)
        self._left = whole.slice(self.batch_rows) if n > self.batch_rows else None
        return whole.slice(0, self.batch_rows).rename_columns(self._arrow.names).cast(self._arrow)

    def close(self) -> None:
        """Lets go of the result, and ends its job if it runs; more than once is no error."""
        if self._rows is not None:
            self._rows = self._left = None
            self._context.cancelJobsWithTag(self._tag)

    def __iter__(self):
        while (batch := self.next_batch()) is not None:
            yield batch

    def __enter__(self) -> QueryStream:
        return self

    def __exit__(self, *_: Any) -> None:
        self.close()


def windowed_counts(events: DataFrame, time: str, key: str, value: str, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Of a stream (or a table): count and sum of value for each key and window, with rows later than ``late`` left out by the watermark."""
    marked = events.withWatermark(time, late)
    found = marked.groupBy(F.window(time, length).alias("w"), key).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return found.select(F.col("w.start").alias("start"), key, "n", "total")


def to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Writes what a stream has so far as Parquet, each row once, and ends."""
    query = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
    return query
