"""What the operators share: the folder that all executors see, written tables, and files in it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_DIR = "spark.checkpoint.dir"
#: Rows and bytes of texts that a function gets at once, about.
MOST_ROWS, MOST_BYTES = 2000, 16 << 20
#: Letters of a text that tell rows of one id apart when they are dealt by ranges.
LEAD = 64


#: Of local applications without a shared folder: their own.
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The URI of the folder that the driver and all executors share.

    It is the one that the cluster names in ``spark.checkpoint.dir``. Only a local session may do
    without that setting; it then gets a temporary folder, named once per application.
    """
    context = spark.sparkContext
    named = context.getConf().get(_DIR)
    if not named:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError(f"set {_DIR} to a folder that all executors share")
        if context.applicationId not in _own:
            _own[context.applicationId] = tempfile.mkdtemp(prefix="tessera-")
        named = _own[context.applicationId]
    return qualified(spark, named)


def qualified(spark: SparkSession, path: str) -> str:
    """A folder's URI; a bare path is on the default file system of the cluster."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString().rstrip("/")
    return whole if "://" in whole else whole.replace(":", "://", 1)


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Folders that go when the innermost passing() ends.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What written() writes within is removed at the end; what is read later must be written otherwise."""
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            discard(spark, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: cuts lineage, and a lost executor loses nothing."""
    path = scratch(df.sparkSession, name)
    if (paths := _passing.get()) is not None:
        paths.append(path)
    return stored(df, path)


def stored(df: DataFrame, path: str) -> DataFrame:
    """df, written to that folder and read again."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder that scratch() named."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle gets that Spark must not coalesce."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_order(rows: DataFrame, shards: int | None, shard_bytes: int = 256 << 20) -> DataFrame:
    """rows (doc_id, text) dealt by ranges of id, and sorted so: equal ids by the text; null ids first.

    The text's first LEAD letters are part of the range, so rows of one id, or without one, are no
    hot key, and no whole text is sampled for the ranges' bounds. Without
    ``shards`` there is one for every ``shard_bytes`` of text, and no fewer than a shuffle has.
    """
    if shards is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(partitions(rows.sparkSession), -(-size // shard_bytes))
    return rows.repartitionByRange(shards, F.col("doc_id"), F.substring("text", 1, LEAD)).sortWithinPartitions("doc_id", "text")


def before(value: str, order: str):
    """The sum of ``value`` over the rows before this one. For tables with a row per partition only."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0))


def arrow_map(df: DataFrame, fun: Callable, schema: str) -> DataFrame:
    """df.mapInArrow(fun, schema) for long texts: fun gets no more than 2,000 rows, or about 16 MB of them, at once.

    Batches of the session's size are cut again, by what their rows take; no conf of the session is changed.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bounded() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = min(MOST_ROWS, max(1, batch.num_rows * MOST_BYTES // max(1, batch.nbytes)))
                yield from (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))

        return fun(bounded())

    return df.mapInArrow(cut, schema)


def opened(uri: str):
    """pyarrow's file system for a URI, and the path in it. Runs on executors."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    return fs.FileSystem.from_uri("s3:" + rest if colon and scheme in ("s3a", "s3n") else uri)


def runs(sizes, most: int):
    """Slices of consecutive items, of ``most`` in total size or one item each."""
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))
