import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tessera.llm.common import runs
from tessera.llm.encode import Encoder
from tessera.llm.tokens import read_tokens, write_tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "the", " ", "\n", "\t", "\xa0", "é", "'s", "1", "\x1c", " the", "\r\n", "Σ", ".", ",", "***", "İ", "x́", "<|endoftext|>", "<|", "The", "\x00", "  ", "ß"]


@pytest.mark.parametrize(("name", "cut"), [("byte_bpe_50k.json", "space"), ("word_bpe_49k.json", "white")])
def test_chunks_are_encoded_as_whole_texts_are(name, cut):
    r = random.Random(3)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 14))) for _ in range(4000)]
    path = public_tokenizers.path(name)
    assert Encoder(path, cut, most=50)(texts) == Encoder(path, None)(texts)


@pytest.mark.parametrize(("name", "cut"), [("byte_bpe_50k.json", "space"), ("word_bpe_49k.json", "white")])
def test_new_chunks_are_sought_without_a_walk_over_all_that_are_kept(name, cut):
    class Kept(dict):
        walks = 0

        def keys(self):
            Kept.walks += 1
            return super().keys()

    encode = Encoder(public_tokenizers.path(name), cut)
    encode.kept = Kept()
    texts = [f"Words, w{chr(97 + i)}ord é{chr(97 + i)}: number {i}.\nThe end" for i in range(20)]
    assert [encode([x])[0] for x in texts] == Encoder(public_tokenizers.path(name), None)(texts)
    assert not Kept.walks and "Words," in encode.kept


def test_white_space_is_that_of_python():
    texts = [x for x in map(chr, range(0x110000)) if not "\ud800" <= x <= "\udfff"]
    texts = [f"a{x}b" for x in texts] + ["", " ", "a\n", "\x85a", "a \u2003 b\u3000"]
    found = pc.utf8_split_whitespace(pa.array(texts)).to_pylist()
    assert [[y for y in x if y] for x in found] == [x.split() for x in texts]


def test_runs_hold_every_item_once():
    sizes = [3, 9, 0, 1, 1, 12, 2]
    assert [i for s in runs(sizes, 5) for i in range(len(sizes))[s]] == list(range(len(sizes)))
    assert list(runs([], 5)) == []


def test_files_give_back_every_id(spark):
    rows = [(3, "The hat."), (1, None), (2, ""), (3, "a second text of one id"), (None, "no id"), (7, "word " * 5000)]
    docs = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, ids string")
    shards = write_tokens(docs, BYTES, "space", 2, shards=3)
    found = read_tokens(shards).collect()
    whole = Encoder(BYTES, None)
    ordered = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    start = 0
    for row, (doc_id, text) in zip(sorted(found, key=lambda x: x["start"]), ordered, strict=True):
        ids = np.append(np.frombuffer(whole([text or ""])[0], "<u2"), 2).astype("<u4")
        assert (row["doc_id"], row["start"], row["n_tokens"], bytes(row["ids"])) == (doc_id, start, len(ids), ids.tobytes())
        start += len(ids)
    digests = {(x["doc_id"], x["start"]): x["ids_crc32"] for x in read_tokens(shards, digests=True).collect()}
    assert digests == {(x["doc_id"], x["start"]): zlib.crc32(bytes(x["ids"])) for x in found}


def test_empty_table(spark):
    shards = write_tokens(spark.createDataFrame([], "doc_id long, text string"), BYTES, "space", 2)
    assert shards.count() == 0 and read_tokens(shards).count() == 0
