"""Operator 9: packing tokenized documents, in order, into sequences with the least waste.

Candidate cuts are the ends of documents (free) and of sentences (each costs ``SENTENCE``), and
within a sentence of more than ``GAP`` tokens also every ``GAP`` tokens (``INSIDE``). A sequence of
n tokens wastes window - n. f(j), the least waste of the tokens before cut j, is penalty(j) +
window - b(j) + min(f(i) + b(i)) over the cuts i that lie within a window before b(j), and a
monotone queue holds those minima: each cut enters and leaves it once.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import takewhile

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, before, in_order, runs, written
from .encode import Encoder, encoder

SENTENCE, INSIDE, GAP = 4, 64, 512
#: Tokens that are cut up at once; all but the last sequence is then final.
BLOCK = 1 << 20


def best_cuts(ends: list[int], costs: list[int], window: int, last: bool = True, rest: Callable[[int], int] = lambda n: 0) -> list[int]:
    """The cuts, out of ``ends``, that waste least; gaps between ends are at most ``window``.

    With ``last``, the final end is among them. Without, tokens after the last cut are left over:
    n of them, under a window, cost ``rest(n)``.
    """
    begins, best, came = [0, *ends], [0], [0]
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (f(i) + b(i), i), rising
    pop, push = queue.pop, queue.append
    k = 0
    for b, cost in zip(ends, costs):
        k += 1
        while begins[queue[0][1]] < b - window:
            queue.popleft()
        least, i = queue[0]
        f = cost + window - b + least
        best.append(f)
        came.append(i)
        f += b
        while queue and queue[-1][0] >= f:
            pop()
        push((f, k))
    total = begins[-1]
    near = takewhile(lambda i: begins[i] > total - window, range(len(ends), -1, -1))
    j = len(ends) if last else min(near, key=lambda i: best[i] + rest(total - begins[i]))
    cuts = []
    while j:
        cuts.append(begins[j])
        j = came[j]
    return cuts[::-1]


def power_pieces(n: int) -> list[int]:
    """Lengths that are powers of two, the largest first, and make up n."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


class _Packer:
    def __init__(self, window: int, ends, sentence: int, inside: int):
        self.window, self.is_end, self.sentence, self.inside = window, ends, sentence, inside
        self.docs: list[tuple] = []  # (doc_id, ids, tokens of it that are packed already)
        self.held = 0
        self.sequence = 0

    def add(self, doc_id, ids) -> None:
        self.docs.append((doc_id, ids, 0))
        self.held += len(ids)

    def candidates(self):
        import numpy as np

        flat = np.concatenate([ids[done:] for _, ids, done in self.docs])
        doc_ends = np.cumsum([len(ids) - done for _, ids, done in self.docs])
        cost = np.full(len(flat) + 1, -1, np.int32)
        cost[np.flatnonzero(self.is_end[flat]) + 1] = self.sentence
        cost[doc_ends] = 0
        at = np.flatnonzero(cost >= 0)
        gaps = np.diff(at, prepend=0)
        gap = min(GAP, self.window)
        for i in np.flatnonzero(gaps > gap).tolist():
            cost[np.arange(at[i] - gaps[i] + gap, at[i], gap)] = self.inside
        at = np.flatnonzero(cost >= 0)
        return at.tolist(), cost[at].tolist()

    def split_cost(self, parts: list[int]) -> int:
        return self.inside * (len(parts) - 1)

    def tail_cost(self, n: int) -> int:
        """What the last n tokens cost: as powers of two, or padded."""
        return min(self.window - n, self.split_cost(power_pieces(n))) if n else 0

    def cut(self, last: bool) -> list[tuple]:
        """Pieces (doc_id, start, ids, tokens of the document, sequence, offset); keeps what is left over."""
        if not self.docs:
            return []
        cuts = best_cuts(*self.candidates(), self.window, False, self.tail_cost if last else lambda n: 0)
        begin = cuts[-1] if cuts else 0
        if last and begin < self.held:
            parts = power_pieces(self.held - begin)
            if self.split_cost(parts) >= self.window - (self.held - begin):
                parts = [self.held - begin]
            for n in parts:
                begin += n
                cuts.append(begin)
        out, k, offset, at = [], 0, 0, 0
        kept = []
        for doc_id, ids, done in self.docs:
            while done < len(ids):
                if k == len(cuts):
                    kept.append((doc_id, ids, done))
                    break
                n = min(len(ids) - done, cuts[k] - at)
                out.append((doc_id, done, ids[done : done + n], len(ids), self.sequence, offset))
                done, at, offset = done + n, at + n, offset + n
                if at == cuts[k]:
                    k, offset, self.sequence = k + 1, 0, self.sequence + 1
        self.docs, self.held = kept, sum(len(ids) - done for _, ids, done in kept)
        return out


_PIECE = pa.schema([("shard", pa.int32()), ("local", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


@lru_cache(maxsize=4)
def _stops(encode: Encoder, end_id: int):
    """Whether an id ends a sentence, for each id; once for each worker process."""
    import numpy as np

    stops = np.zeros(max(encode.size, end_id + 1), bool)
    for text, i in encode.tokenizer.get_vocab().items():
        stops[i] = text.removesuffix("</w>")[-1:] in tuple(".!?") and len(text) < 12
    return stops


def _pack(tokenizer: str, cut: str | None, end_id: int, window: int, sentence: int, inside: int, with_ids: bool):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encode = encoder(tokenizer, cut)
        shard = TaskContext.get().partitionId()
        packer = _Packer(window, _stops(encode, end_id), sentence, inside)

        def rows(pieces):
            for i in range(0, len(pieces), 20_000):
                doc_id, start, ids, tokens, sequence, offset = zip(*pieces[i : i + 20_000])
                own = [x.astype("<u4") for x in ids]
                n = len(own)
                yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(([shard] * n, sequence, doc_id, start, [len(x) for x in own], [zlib.crc32(x) for x in own], tokens, offset, [x.tobytes() if with_ids else None for x in own]), _PIECE.types)], schema=_PIECE)

        end = np.array([end_id], encode.dtype if end_id < 1 << 16 else "<u4")
        for batch in batches:
            texts = batch.column(1).fill_null("").to_pylist()
            names = batch.column(0).to_pylist()
            for part in runs([len(x) for x in texts], 1 << 20):
                for doc_id, ids in zip(names[part], encode(texts[part])):
                    packer.add(doc_id, np.concatenate([np.frombuffer(ids, encode.dtype), end]))
                    if packer.held >= BLOCK:
                        yield from rows(packer.cut(False))
        yield from rows(packer.cut(True))

    return pack


def pack(docs: DataFrame, tokenizer: str, cut: str | None, end_id: int, window: int = 4096, id_col: str = "doc_id", text_col: str = "text", sentence: int = SENTENCE, inside: int = INSIDE, with_ids: bool = True, shards: int | None = None) -> DataFrame:
    """Packs whole documents into sequences of at most ``window`` tokens; returns a row for each piece.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids (binary,
    little-endian unsigned 32-bit) with ``with_ids``. Each document's ids end with ``end_id``; a
    null text is an empty one, so it has that id alone. Documents keep the order of their ids
    (equal ids by text; a null id first), within a shard and from shard to shard. A shard is a
    range of ids, cut up by itself, so that at most its last sequence is short; that one is split
    into powers of two, which need no padding, where the cuts cost less than the padding. An empty
    table gives no piece; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    dealt = in_order(rows, shards)
    schema = "shard int, local long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, offset long, ids binary"
    pieces = written(arrow_map(dealt, _pack(tokenizer, cut, end_id, window, sentence, inside, with_ids), schema), "pieces")
    sizes = pieces.groupBy("shard").agg((F.max("local") + 1).alias("n")).withColumn("base", before("n", "shard"))
    joined = pieces.join(F.broadcast(sizes.select("shard", "base")), "shard")  # a row for each shard
    out = joined.withColumn("sequence_id", F.col("base") + F.col("local"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids)
