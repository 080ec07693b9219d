"""Operator 2: texts as grayscale PNG images in a binary column, read back, with frequency hashes.

A text's UTF-8 bytes, padded with zeros to a positive multiple of 64, are the samples of an 8-bit
grayscale image 64 pixels wide. The PNG writer filters each row as none, sub or up, whichever gives
the least sum of magnitudes; the reader checks every chunk's checksum and undoes all five filters.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

WIDTH = 64
#: The first bytes of every PNG file; fixed by the format.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Bytes of image data in one chunk.
CHUNK = 1 << 16
LEVEL = 4


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def padded(data: bytes) -> bytes:
    return data + bytes(max(WIDTH, -(-len(data) // WIDTH) * WIDTH) - len(data))


def encode_png(payload: bytes) -> bytes:
    """An 8-bit grayscale PNG of the payload, whose length is a positive multiple of 64."""
    import numpy as np

    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    ways = np.zeros((3, *rows.shape), np.uint8)
    ways[:] = rows
    ways[1, :, 1:] -= rows[:, :-1]
    ways[2, 1:] -= rows[:-1]
    cost = np.minimum(ways, -ways).sum(2, dtype=np.int64)
    kind = cost.argmin(0)
    lines = np.empty((len(rows), WIDTH + 1), np.uint8)
    lines[:, 0] = kind
    lines[:, 1:] = ways[kind, np.arange(len(rows))]
    packed = zlib.compress(lines.tobytes(), LEVEL)
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    data = b"".join(_chunk(b"IDAT", packed[i : i + CHUNK]) for i in range(0, len(packed), CHUNK))
    return SIGNATURE + _chunk(b"IHDR", head) + data + _chunk(b"IEND", b"")


def unfilter(kinds, lines):
    """Undoes PNG's row filters for samples of a byte each: lines is (rows, width) of uint8."""
    import numpy as np

    out = lines.copy()
    sub = kinds == 1
    if sub.any():
        out[sub] = np.cumsum(lines[sub], axis=1, dtype=np.uint8)
    if (kinds < 3).all():
        up = kinds == 2
        edges = np.flatnonzero(np.diff(up.astype(np.int8), prepend=0, append=0))
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            run = lines[begin:end].cumsum(axis=0, dtype=np.uint8)
            out[begin:end] = run + out[begin - 1] if begin else run
        return out
    above = np.zeros(lines.shape[1], np.uint8)
    for i, kind in enumerate(kinds.tolist()):
        if kind == 2:
            out[i] = lines[i] + above
        elif kind > 2:
            left = corner = 0
            row = lines[i].tolist()
            for j, b in enumerate(above.tolist()):
                if kind == 3:
                    guess = (left + b) >> 1
                else:
                    p = left + b - corner
                    near = (abs(p - left), abs(p - b), abs(p - corner))
                    guess = (left, b, corner)[near.index(min(near))]
                left, corner = (row[j] + guess) & 255, b
                row[j] = left
            out[i] = row
        above = out[i]
    return out


def decode_png(data: bytes):
    """The samples, (rows, 64) of uint8; raises ValueError where signature, checksums or header are wrong."""
    import numpy as np

    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG file")
    at, packed, head, kind = 8, [], None, b""
    while kind != b"IEND":
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", data, at + 8 + size)[0] != zlib.crc32(body, zlib.crc32(kind)):
            raise ValueError(f"checksum of chunk {kind!r}")
        at += 12 + size
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
    if head is None or head[0] != WIDTH or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError(f"unexpected header {head}")
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(head[1], WIDTH + 1)
    return unfilter(lines[:, 0], lines[:, 1:])


@cache
def _cosines(n: int = 32, low: int = 8):
    import numpy as np

    k, x = np.arange(low)[:, None], np.arange(n)[None, :]
    return np.cos(np.pi * k * (2 * x + 1) / (2 * n))


def frequency_hash(rows) -> bytes:
    """64 bits: which of the 8 x 8 lowest cosine frequencies of the 32 x 32 image are above their median.

    The image is averaged down (or its rows repeated) to 32 x 32; the constant part's bit is 0.
    """
    import numpy as np

    h = len(rows)
    if h >= 32:
        edges = np.arange(32) * h // 32
        tall = np.add.reduceat(rows, edges, axis=0, dtype=np.float64) / np.diff(edges, append=h)[:, None]
    else:
        tall = rows[np.arange(32) * h // 32].astype(np.float64)
    small = tall.reshape(32, 32, -1).mean(2)
    low = (_cosines() @ small @ _cosines().T).ravel()
    bits = low > np.median(low[1:])
    bits[0] = False
    return np.packbits(bits).tobytes()


_MEDIA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = batch.column(1).fill_null("").cast(pa.binary()).to_pylist()
        media = [encode_png(padded(x)) for x in raw]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary())], schema=_MEDIA)


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts as images: doc_id, n_bytes (before padding), media (binary; a PNG file).

    A row for each row, also of equal ids; a null text is an empty one, and that is a row of zeros.
    Equal texts give equal media. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(rows, _encode, "doc_id long, n_bytes long, media binary")


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "phash"]
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for media in batch.column(2).to_pylist():
            rows = decode_png(media)
            payload = rows.tobytes()
            for column, x in zip(out, (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), frequency_hash(rows))):
                column.append(x)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary())
        read = [pa.array(x, y) for x, y in zip(out, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *read, batch.column(2)], [*names, "media"])


def media_features(media: DataFrame) -> DataFrame:
    """What the stored images of to_media() hold: payload_bytes, payload_sha256, tail_crc32 (of the last
    64 bytes) and phash (binary; 64 bits), beside to_media()'s columns. A damaged image is an error."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, phash binary, media binary"
    return arrow_map(media.select("doc_id", "n_bytes", "media"), _decode, schema)


def media_digests(docs: DataFrame) -> DataFrame:
    """media_features() of to_media(), with the media as length and digest."""
    found = media_features(to_media(docs))
    return found.select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32",
        F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), F.lower(F.hex("phash")).alias("feature"),
    )
