import base64
import hashlib

import pytest

from tessera.llm.warc import _member, _members, _parsed, read_headers, resolve_revisits, write_archives

ROWS = [(5, "http://a/5", "same"), (2, "http://a/2", "same"), (9, None, "same"), (1, "http://b", "other"), (3, "u", None), (4, "u", ""), (None, "http://none", "same"), (7, "two\nlines", "é" * 70_000), (2, "http://a/2", "same")]


@pytest.mark.parametrize("least", [0, 1])
def test_revisits_name_the_first_record(spark, least):
    pages = spark.createDataFrame([(*x, "clash") for x in ROWS], "page_id long, url string, html string, payload_bytes string").repartition(3)
    archives = write_archives(pages)
    assert {r["record_type"] for r in read_headers(archives).collect()} == {"response"}
    rows = read_headers(resolve_revisits(archives, least)).collect()
    digest = lambda x: base64.b32encode(hashlib.sha1((x or "").encode()).digest()).decode()
    assert sorted((r["payload_digest"], r["payload_bytes"]) for r in rows) == sorted((digest(x), len((x or "").encode())) for *_, x in ROWS)
    for r in rows:
        own = [k for k, _, x in ROWS if digest(x) == r["payload_digest"] and k is not None]
        if r["record_type"] == "revisit":
            assert r["refers_to"] == min(own) and r["payload_bytes"] >= least
        else:
            assert r["refers_to"] is None
    firsts = [(r["payload_digest"], r["page_id"]) for r in rows if r["record_type"] == "response" and r["payload_bytes"] >= least]
    assert len(firsts) == len({x for x, _ in firsts})
    assert sum(r["record_type"] == "response" for r in rows if not r["payload_bytes"]) == (1 if least == 0 else 2)


def test_empty_table(spark):
    archives = write_archives(spark.createDataFrame([], "page_id long, url string, html string"))
    assert read_headers(resolve_revisits(archives)).count() == 0


def contents(archives):
    """Of every record: its fields and payload."""
    return [_parsed(raw)[::2] for row in archives.collect() for _, _, raw in _members(row["path"])]


def sound(archives, before):
    """Every reference names a record that exists; payloads and dates are those of before (page ids are distinct)."""
    found = contents(archives)
    ids = {f["warc-record-id"]: (f, payload) for f, payload in found}
    dates = {f["x-page-id"]: f["warc-date"] for f, _ in before}
    payloads = {f["x-page-id"]: p for f, p in before if f["warc-type"] == "response"}
    assert len(ids) == len(found) == len(before)
    for f, payload in found:
        assert f["warc-date"] == dates[f["x-page-id"]]
        if f["warc-type"] == "response":
            assert payload == payloads[f["x-page-id"]] and f["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
        elif f["warc-refers-to"] in ids:
            first, own = ids[f["warc-refers-to"]]
            assert first["warc-type"] == "response" and first["warc-payload-digest"] == f["warc-payload-digest"] and first["warc-date"] == f["warc-refers-to-date"] and first["x-page-id"] == f["x-refers-to-page-id"]
    return {f["x-page-id"]: (f["warc-type"], f.get("x-refers-to-page-id"), f.get("warc-refers-to") in ids) for f, _ in found}


def test_archives_that_hold_revisits(spark):
    make = lambda rows: write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2))
    archives = make([(1, "u", "same"), (2, "u", "same"), (3, "u", ""), (4, "u", ""), (9, "u", "x" * 90)])
    before = contents(archives)
    want = {"1": ("response", None, False), "2": ("revisit", "1", True), "3": ("response", None, False), "4": ("revisit", "3", True), "9": ("response", None, False)}
    once = resolve_revisits(archives, 0)
    for least in (0, 1, 100):  # again, with a rising limit, from what was resolved and from the pages
        assert sound(resolve_revisits(once, least), before) == want
    large = resolve_revisits(archives, 100)
    assert {x for x, *_ in sound(large, before).values()} == {"response"} and sound(resolve_revisits(large, 0), before) == want
    # a union in which a new response has the smallest id: revisits have no payload, so they stay revisits
    other = make([(0, "u", "same"), (7, "u", "same"), (8, "u", "x" * 90)])
    both = sound(resolve_revisits(once.union(other), 0), before + contents(other))
    assert both == {**want, "0": ("response", None, False), "1": ("revisit", "0", True), "2": ("revisit", "0", True), "7": ("revisit", "0", True), "8": ("response", None, False), "9": ("revisit", "8", True)}


def test_a_revisit_without_its_original_keeps_its_reference(spark, tmp_path):
    first = {"WARC-Type": "revisit", "WARC-Record-ID": "<urn:x:1>", "WARC-Date": "2020-01-01T00:00:00Z", "WARC-Payload-Digest": "sha1:ABC", "WARC-Refers-To": "<urn:x:0>", "WARC-Refers-To-Date": "2019-01-01T00:00:00Z", "X-Page-ID": 3}
    info = {"WARC-Type": "warcinfo", "WARC-Record-ID": "<urn:x:2>", "WARC-Date": "2020-01-01T00:00:00Z"}
    (tmp_path / "a.warc.gz").write_bytes(_member(info, b"software: x") + _member(first, b"HTTP/1.1 304\r\nX: y\r\n\r\n") + _member({**info, "WARC-Type": "response"}, b"HTTP/1.1 200 OK\r\nX: own\r\n\r\nbody"))
    archives = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz", 3)], "path string, n_records long")
    found = [(f, http, p) for row in resolve_revisits(archives).collect() for _, _, raw in _members(row["path"]) for f, http, p in [_parsed(raw)]]
    kinds = {f["warc-type"]: (f, http, p) for f, http, p in found}
    f, http, _ = kinds["revisit"]
    assert len(found) == 3 and kinds["response"][1:] == (b"HTTP/1.1 200 OK\r\nX: own\r\n\r\n", b"body") and b"X: y" in http
    assert (f["warc-refers-to"], f["warc-refers-to-date"], f["warc-date"], f["warc-payload-digest"]) == ("<urn:x:0>", "2019-01-01T00:00:00Z", "2020-01-01T00:00:00Z", "sha1:ABC")
