"""Operator 1: token ids in flat binary files, with 64-bit offsets, read back through memory maps.

A shard is three flat little-endian files of one name: ``.ids`` (unsigned 16- or 32-bit ids),
``.offsets`` (64-bit; where each document begins in the shard, and the shard's length at the end)
and ``.docs`` (64-bit document ids). Shards follow each other in ascending document id, and a
shard's base is the sum of the tokens of the shards before it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, before, in_order, opened, partitions, runs, scratch, written
from .encode import encoder

SHARD = "shard int, path string, id_bytes int, n_docs long, n_tokens long"
#: Stands for a null document id in a .docs file.
NO_ID = -(1 << 63)


def _write_shard(folder: str, tokenizer: str, cut: str | None, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encode = encoder(tokenizer, cut)
        dtype = encode.dtype if end_id < 1 << 16 else "<u4"
        shard = TaskContext.get().partitionId()
        store, root = opened(folder)
        path, files = f"{root}/{shard:06d}-{uuid.uuid4().hex}", None
        n_docs = n_tokens = 0
        for batch in batches:
            if files is None and batch.num_rows:
                store.create_dir(root, recursive=True)
                files = [store.open_output_stream(f"{path}.{x}") for x in ("ids", "offsets", "docs")]
                files[1].write(np.zeros(1, "<i8").tobytes())
            ids = batch.column(0).fill_null(NO_ID).to_numpy().astype("<i8")
            texts = batch.column(1).fill_null("").to_pylist()
            for part in runs([len(x) for x in texts], 1 << 20):
                found = [np.frombuffer(x, encode.dtype) for x in encode(texts[part])]
                end = np.array([end_id], dtype)
                files[0].write(np.concatenate([y for x in found for y in (x.astype(dtype, copy=False), end)]).tobytes())
                ends = n_tokens + np.cumsum([len(x) + 1 for x in found])
                files[1].write(ends.astype("<i8").tobytes())
                files[2].write(ids[part].tobytes())
                n_docs, n_tokens = n_docs + len(found), int(ends[-1])
        if files is not None:
            for x in files:
                x.close()
            row = {"shard": [shard], "path": [f"{folder}/{path.rpartition('/')[2]}"], "id_bytes": [int(dtype[2])], "n_docs": [n_docs], "n_tokens": [n_tokens]}
            yield pa.RecordBatch.from_pydict(row, pa.schema([("shard", pa.int32()), ("path", pa.string()), ("id_bytes", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    return write


def write_tokens(docs: DataFrame, tokenizer: str, cut: str | None, end_id: int, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, shards: int | None = None) -> DataFrame:
    """Encodes whole texts and writes them as shards; returns a row for each shard, with its base.

    Columns: shard, path (a URI without the suffix), id_bytes, n_docs, n_tokens, base. A null text
    counts as an empty one, and each document ends with ``end_id``. Documents are dealt by ranges
    of their id, so the text is shuffled once, and each task writes its shard as it encodes.
    Documents of one id follow each other by text; a null id comes first. An empty table gives no
    shard. Other columns are not read. The files of a task that failed are left unnamed by the
    result.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    dealt = in_order(rows, shards)
    found = written(arrow_map(dealt, _write_shard(folder, tokenizer, cut, end_id), SHARD), "shards")
    return found.withColumn("base", before("n_tokens", "shard"))


def _mapped(uri: str):
    """A file's bytes, memory-mapped where it is local."""
    from pyarrow import fs

    store, path = opened(uri)
    file = pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)
    return file, file.size()


def _read_shards(digests: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for row in (x for b in batches for x in b.to_pylist()):
            (ids, _), (offsets, n), (docs, m) = (_mapped(f"{row['path']}.{x}") for x in ("ids", "offsets", "docs"))
            ends = np.frombuffer(offsets.read_buffer(n), "<i8")
            names = np.frombuffer(docs.read_buffer(m), "<i8")
            wide = row["id_bytes"]
            for part in runs(np.diff(ends).tolist(), 1 << 20):
                begin, end = int(ends[part.start]), int(ends[part.stop])
                ids.seek(begin * wide)
                block = np.frombuffer(ids.read_buffer((end - begin) * wide), f"<u{wide}").astype("<u4")
                own = [block[a - begin : b - begin] for a, b in zip(ends[part].tolist(), ends[part.start + 1 : part.stop + 1].tolist())]
                out = [
                    pa.array(names[part], mask=names[part] == NO_ID),
                    pa.array(ends[part] + row["base"]),
                    pa.array(np.diff(ends[part.start : part.stop + 1])),
                    pa.array([zlib.crc32(x) for x in own], pa.int64()) if digests else pa.array([x.tobytes() for x in own], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "start", "n_tokens", "ids_crc32" if digests else "ids"])

    return read


def read_tokens(shards: DataFrame, digests: bool = False) -> DataFrame:
    """The documents of write_tokens()'s shards, from their files.

    Columns: doc_id, start (ids before it in all shards), n_tokens and ids (binary; unsigned
    little-endian 32-bit, whatever the file holds), or with ``digests`` their crc32 as ids_crc32.
    A task maps one shard after another and holds a million ids at a time.
    """
    last = "ids_crc32 long" if digests else "ids binary"
    spread = shards.repartition(partitions(shards.sparkSession))
    return spread.mapInArrow(_read_shards(digests), f"doc_id long, start long, n_tokens long, {last}")
