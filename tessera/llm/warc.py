"""Operator 5: web archives, and revisit records in place of repeated payloads.

An archive is a gzip file of WARC/1.1 records, a member for each. Its records are HTTP responses;
the block is a short HTTP header and the payload. Revisit records have the header only, and name
the record that has the payload.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, opened, partitions, scratch, written

#: Fixed by the WARC standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
LEVEL = 3
#: Bytes that are inflated at once: what lies behind a record in them is copied.
_STEP = 1 << 14


def _member(fields: dict[str, object], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    packer = zlib.compressobj(LEVEL, wbits=31)
    return packer.compress(f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n") + packer.flush()


def _parsed(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """A record's fields (by lower-case name), the HTTP header of its block with the empty line, and its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    block = rest[: int(fields["content-length"])]
    http, end, payload = block.partition(b"\r\n\r\n")
    return fields, http + end, payload


def _now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def _clean(url: str | None) -> str | None:
    """A field's value has one line."""
    return None if url is None else " ".join(url.split()) or None


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, record_id: str, date: str, page_id, url: str | None, http: bytes, payload: bytes, digest: str, size: int | None, refers: dict[str, object] | None = None) -> bytes:
    fields = {
        "WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": date, "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http; msgtype=response",
        "X-Page-ID": page_id, "X-Payload-Length": size, **(refers or {}),
    }
    return _member(fields, http + payload)


FILES = "path string, n_records long"
_FILES = pa.schema([("path", pa.string()), ("n_records", pa.int64())])


class _Writer:
    """One archive, named when it is complete."""

    def __init__(self, folder: str):
        self.folder, self.name = folder, f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        store, root = opened(folder)
        store.create_dir(root, recursive=True)
        self.file, self.n = store.open_output_stream(f"{root}/{self.name}", compression=None), 0

    def add(self, record: bytes) -> None:
        self.file.write(record)
        self.n += 1

    def close(self) -> pa.RecordBatch:
        self.file.close()
        return pa.RecordBatch.from_pydict({"path": [f"{self.folder}/{self.name}"], "n_records": [self.n]}, _FILES)


def _write(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            payloads = batch.column(2).fill_null("").cast(pa.binary()).to_pylist()
            for page_id, url, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), payloads):
                out = out or _Writer(folder)
                out.add(_record("response", f"<urn:uuid:{uuid.uuid4()}>", _now(), page_id, _clean(url), _HTTP, payload, _digest(payload), len(payload)))
        if out:
            yield out.close()

    return write


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None) -> DataFrame:
    """Writes a response record for each page, an archive for each partition; returns path and n_records.

    A null html is an empty payload; a null url leaves its field out, as a null id does. An empty
    table gives no archive. Other columns are not read.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return written(arrow_map(rows, _write(folder or scratch(pages.sparkSession, "warc")), FILES), "archives")


def _members(path: str) -> Iterator[tuple[int, int, bytes]]:
    """Each member of a gzip file: where it begins, its size, and its content."""
    store, name = opened(path)
    with store.open_input_file(name) as file:
        begin, buffer, at = 0, b"", 0
        while True:
            packer, out, size = zlib.decompressobj(wbits=31), [], 0
            while not packer.eof:
                if at == len(buffer):
                    buffer, at = file.read(1 << 20), 0
                    if not buffer:
                        if size:
                            raise ValueError(f"{path} ends within a record")
                        return
                data = buffer[at : at + _STEP]
                out.append(packer.decompress(data))
                used = len(data) - len(packer.unused_data)
                at += used
                size += used
            yield begin, size, b"".join(out)
            begin += size


_HEADERS = {
    "path": pa.string(), "at": pa.int64(), "size": pa.int64(), "page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_digest": pa.string(), "payload_bytes": pa.int64(),
    "record_id": pa.string(), "date": pa.string(), "refers_to": pa.int64(), "refers_id": pa.string(), "refers_url": pa.string(), "refers_date": pa.string(),
}
HEADERS = ", ".join(f"{k} {'long' if v == pa.int64() else 'string'}" for k, v in _HEADERS.items())


def _whole(x: str | None) -> int | None:
    return None if x is None else int(x)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*rows), _HEADERS.values())], list(_HEADERS))

    for path in (x for b in batches for x in b.column(0).to_pylist()):
        rows: list[tuple] = []
        for at, size, raw in _members(path):
            fields, _, payload = _parsed(raw)
            kind, digest, length = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, _whole(fields.get("x-payload-length"))
            if kind == "response":
                own = _digest(payload)
                if digest not in (None, own):
                    raise ValueError(f"{path} at {at}: the payload is not the one that was written")
                digest, length = own, len(payload)
            refers = _whole(fields.get("x-refers-to-page-id")), fields.get("warc-refers-to"), fields.get("warc-refers-to-target-uri"), fields.get("warc-refers-to-date")
            rows.append((path, at, size, _whole(fields.get("x-page-id")), fields.get("warc-target-uri"), kind, digest, length, fields.get("warc-record-id"), fields.get("warc-date"), *refers))
            if len(rows) == 5000:
                yield out()
                rows = []
        if rows:
            yield out()


def read_headers(archives: DataFrame) -> DataFrame:
    """The headers of all records, with path, at and size (where the record is); payloads are checked against their digests."""
    spread = archives.select("path").repartition(partitions(archives.sparkSession))
    return spread.mapInArrow(_read, HEADERS)


def _fresh(folder: str, record_id: str | None, path: str, at: int) -> str:
    """A record's id in the new archives: the same from every task that needs it, and when one runs again."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{folder} {record_id or (path, at)}')}>"


def _rewrite(folder: str):
    def refers(row: dict) -> dict[str, object]:
        first = row["original"]
        if first is None:  # its original is in none of these archives: it refers to what it did
            return {"WARC-Profile": PROFILE, "WARC-Refers-To": row["refers_id"], "WARC-Refers-To-Target-URI": row["refers_url"], "WARC-Refers-To-Date": row["refers_date"], "X-Refers-To-Page-ID": row["refers_to"]}
        return {"WARC-Profile": PROFILE, "WARC-Refers-To": _fresh(folder, first["record_id"], first["path"], first["at"]), "WARC-Refers-To-Target-URI": first["url"], "WARC-Refers-To-Date": first["date"], "X-Refers-To-Page-ID": first["page_id"]}

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = path = file = None
        for row in (x for b in batches for x in b.to_pylist()):
            if row["path"] != path:
                if file:
                    file.close()
                path = row["path"]
                store, name = opened(path)
                file = store.open_input_file(name)
            out = out or _Writer(folder)
            member = file.read_at(row["size"], row["at"])
            if row["kind"] not in ("response", "revisit"):
                out.add(member)
                continue
            _, http, payload = _parsed(zlib.decompress(member, wbits=31))
            revisit = row["kind"] == "revisit"
            name = _fresh(folder, row["record_id"], path, row["at"])
            out.add(_record(row["kind"], name, row["date"], row["page_id"], row["url"], http, b"" if revisit else payload, row["payload_digest"], row["payload_bytes"], refers(row) if revisit else None))
        if file:
            file.close()
        if out:
            yield out.close()

    return rewrite


def resolve_revisits(archives: DataFrame, least: int = 0, folder: str | None = None) -> DataFrame:
    """Writes new archives in which response records of equal payloads, but for one, are revisits of that one.

    Of response records with equal payloads (by SHA-1) of ``least`` bytes or more, the one with the
    smallest page id stays a response (of equal ids the first by file and place; a null id comes
    last); others lose their payload. Revisit records of the input are joined by digest to these
    originals and stay revisits, whatever their page id, as they hold no payload: one whose original
    is in none of the archives keeps the reference that it had. Records get new headers and record
    ids; capture dates and HTTP headers stay, and a revisit names its original's new record id and
    its date. Records of other types are copied as they are. Only headers are shuffled: by digest,
    with a join that splits frequent digests, then by file, so that each old archive is read in
    order. Returns the new archives, as write_archives() does.
    """
    spark = archives.sparkSession
    headers = written(read_headers(archives), "headers")
    response, revisit = F.col("record_type") == "response", F.col("record_type") == "revisit"
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "path", "at", "record_id", "url", "date")
    grouped = headers.where((response | revisit) & F.col("payload_digest").isNotNull()).groupBy("payload_digest")
    firsts = written(grouped.agg(F.min(F.when(response, order)).alias("original"), F.count("*").alias("n")).where("n > 1 and original is not null").drop("n"), "firsts")
    joined = headers.join(firsts, "payload_digest", "left")
    same = (F.col("original.path") == F.col("path")) & (F.col("original.at") == F.col("at"))
    again = response & F.col("original").isNotNull() & ~same & (F.col("payload_bytes") >= least)
    rows = joined.withColumn("kind", F.when(again, "revisit").otherwise(F.col("record_type"))).drop("record_type")
    dealt = rows.repartition(partitions(spark), "path").sortWithinPartitions("path", "at")
    return written(dealt.mapInArrow(_rewrite(folder or scratch(spark, "warc")), FILES), "archives")


def revisits_sql(least: int = 0) -> str:
    """DuckDB SQL for the records of pages after resolve_revisits()."""
    return f"""
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
named AS (SELECT page_id, n, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (1 + i * 5 // 4)::INTEGER, 2))::INTEGER >> (3 - (i * 5) % 4)::INTEGER) & 31) + 1, 1)), '') AS digest FROM hashed),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM named)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN n >= {least} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {least} AND page_id <> first THEN first END AS refers_to FROM firsts"""
