import random
import zlib

import numpy as np
import public_tokenizers

from tessera.llm.encode import Encoder
from tessera.llm.packing import best_cuts, pack, power_pieces

WORDS = public_tokenizers.path("word_bpe_49k.json")


def slow_least(ends, costs, window):
    begins, best = [0, *ends], [0]
    for b, cost in zip(ends, costs):
        best.append(min(f + window - (b - a) + cost for a, f in zip(begins, best) if b - a <= window))
    return best[-1]


def test_cuts_are_the_best():
    r = random.Random(1)
    for _ in range(200):
        window = r.randint(8, 30)
        ends = np.cumsum([r.randint(1, 8) for _ in range(r.randint(1, 60))]).tolist()
        costs = [r.choice([0, 0, 4, 9]) for _ in ends]
        cuts = best_cuts(ends, costs, window)
        assert cuts[-1] == ends[-1]
        waste = sum(window - (b - a) for a, b in zip([0, *cuts], cuts)) + sum(costs[ends.index(x)] for x in cuts)
        assert waste == slow_least(ends, costs, window)
        left = best_cuts(ends, costs, window, last=False)
        assert ends[-1] - (left[-1] if left else 0) < window


def test_powers():
    assert power_pieces(11) == [8, 2, 1] and power_pieces(4096) == [4096]


def check(rows, texts, window):
    whole = Encoder(WORDS, None)
    ids = {k: np.append(np.frombuffer(whole([v or ""])[0], "<u2"), 2).astype("<u4") for k, v in texts.items()}
    at, pads, places = dict.fromkeys(texts, 0), 0, {}
    for row in sorted(rows, key=lambda x: (x["sequence_id"], x["offset"])):
        own = ids[row["doc_id"]][row["start"] : row["start"] + row["length"]]
        assert row["start"] == at[row["doc_id"]] and len(own) == row["length"] > 0 and row["doc_tokens"] == len(ids[row["doc_id"]])
        assert row["ids_crc32"] == zlib.crc32(own.tobytes()) and bytes(row["ids"]) == own.tobytes()
        assert row["offset"] == places.get(row["sequence_id"], 0)
        at[row["doc_id"]] += row["length"]
        places[row["sequence_id"]] = row["offset"] + row["length"]
    assert at == {k: len(v) for k, v in ids.items()}
    assert sorted(places) == list(range(len(places)))
    for n in places.values():
        assert n <= window
        pads += 0 if n & (n - 1) == 0 else window - n
    return pads / max(1, sum(places.values()))


def test_pieces_hold_every_token_once_with_little_padding(spark):
    r = random.Random(2)
    say = lambda n: " ".join(r.choice(["Stone", "river", "light.", "garden", "seven!", "letter"]) for _ in range(n))
    texts = {k: say(r.choice([3, 40, 300, 3000])) for k in range(200)} | {500: None, 501: "", 502: "x" * 9000 + " " + "word " * 9000}
    docs = spark.createDataFrame([(k, v, 0) for k, v in texts.items()], "doc_id long, text string, offset int")
    assert check(pack(docs, WORDS, "white", 2, shards=3).collect(), texts, 4096) < 0.01
    assert check(pack(docs, WORDS, "white", 2, window=512, shards=3).collect(), texts, 512) < 0.05


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), WORDS, "white", 2).count() == 0
