import hashlib
import zlib

import numpy as np
import pytest

from tessera.llm.media import WIDTH, decode_png, encode_png, frequency_hash, media_digests, media_features, padded, to_media, unfilter


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 4096, 200_000])
def test_png_gives_back_the_bytes(n):
    payload = padded(np.random.default_rng(n).integers(0, 256, n, np.uint8).tobytes())
    assert len(payload) % WIDTH == 0 and payload
    assert decode_png(encode_png(payload)).tobytes() == payload


def slow_unfilter(kinds, lines):
    out = np.zeros_like(lines)
    for y, kind in enumerate(kinds):
        for x in range(lines.shape[1]):
            a = int(out[y, x - 1]) if x else 0
            b = int(out[y - 1, x]) if y else 0
            c = int(out[y - 1, x - 1]) if x and y else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            out[y, x] = (int(lines[y, x]) + [0, a, b, (a + b) // 2, paeth][kind]) % 256
    return out


@pytest.mark.parametrize("top", [3, 5])
def test_all_filters_are_undone(top):
    rng = np.random.default_rng(top)
    kinds, lines = rng.integers(0, top, 40, np.uint8), rng.integers(0, 256, (40, WIDTH), np.uint8)
    assert (unfilter(kinds, lines) == slow_unfilter(kinds, lines)).all()


def test_damage_is_an_error():
    data = bytearray(encode_png(padded(b"hello")))
    data[45] ^= 1
    with pytest.raises(ValueError):
        decode_png(bytes(data))
    with pytest.raises(ValueError):
        decode_png(b"no picture at all")


def test_hash_follows_the_picture():
    rows = np.random.default_rng(0).integers(0, 256, (100, 64), np.uint8)
    near = rows.copy()
    near[0, 0] ^= 3
    differ = lambda a, b: (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()
    assert differ(frequency_hash(rows), frequency_hash(near)) < 6 < differ(frequency_hash(rows), frequency_hash(np.random.default_rng(1).integers(0, 256, (100, 64), np.uint8)))


def test_rows(spark):
    texts = [(1, "Çeci"), (2, None), (3, ""), (1, "Çeci"), (None, "x" * 70_000)]
    docs = spark.createDataFrame([(*x, b"clash") for x in texts], "doc_id long, text string, media binary")
    rows = media_digests(docs).collect()
    assert len(rows) == len(texts)
    want = {(k, hashlib.sha256(padded((v or "").encode())).hexdigest(), len((v or "").encode()), zlib.crc32(padded((v or "").encode())[-64:])) for k, v in texts}
    assert {(r["doc_id"], r["payload_sha256"], r["n_bytes"], r["tail_crc32"]) for r in rows} == want
    assert len({(r["media_sha256"], r["feature"]) for r in rows if r["doc_id"] == 1}) == 1
    assert media_features(to_media(docs.limit(0))).count() == 0
