import os
import random

import numpy as np

import corpus_pipeline as p
from tessera.llm import nearcopies as n
from tessera.llm.common import shared_dir
from tessera.llm.nearcopies import near_copies


def shingles(text):
    found = (text or "").split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def edited(r, text, rate):
    return " ".join(f"new{r.randrange(10**9)}" if r.random() < rate else x for x in text.split())


def components(sets, least=0.8):
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    near = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) >= least * len(a | b):
                near += a != b
                up[find(i)] = find(j)
    return [find(i) for i in range(len(sets))], near


def test_near_dedup_equals_all_pairs(spark):
    r = random.Random(3)
    texts = []
    for n in (8, 30, 100, 100, 300, 300, 1000):
        base = " ".join(f"w{r.randrange(3000)}" for _ in range(n))
        texts += [base] + [edited(r, base, r.choice([0.003, 0.01, 0.02, 0.03, 0.05])) for _ in range(25)]
    chain = [" ".join(f"c{r.randrange(3000)}" for _ in range(200))]
    for _ in range(12):  # neighbours are near, ends are not
        chain.append(edited(r, chain[-1], 0.015))
    passage = " ".join(f"p{r.randrange(3000)}" for _ in range(60))
    texts += [f"{passage} " + " ".join(f"q{r.randrange(3000)}" for _ in range(r.choice([4, 8, 15, 40]))) for _ in range(60)]
    texts += [*chain, "", None, "one two", "one two", texts[0]]
    r.shuffle(texts)
    roots, near = components([shingles(x) for x in texts])
    least = {}
    for i, root in enumerate(roots):
        least[root] = min(i, least.get(root, i))
    want = sorted((i, least[root]) for i, root in enumerate(roots))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert near > 100 and sorted(map(tuple, near_copies(df).collect())) == want
    assert {x["doc_id"] for x in p.near_dedup(spark, df, "").collect()} == set(least.values())
    assert near_copies(df.limit(0)).count() == 0


def test_only_the_kept_rows_stay_on_disk(spark):
    folder = shared_dir(spark).partition("://")[2]
    before = set(os.listdir(folder))
    df = spark.createDataFrame([(i, f"a b c d e f g h {i % 3}") for i in range(9)], "doc_id long, text string")
    assert {x["doc_id"] for x in p.near_dedup(spark, df, "").collect()} == {0, 1, 2}
    assert [x.partition("-")[0] for x in set(os.listdir(folder)) - before] == ["kept"]


def alike(r, groups=8, of=30, length=120):
    texts = []
    for g in range(groups):
        base = " ".join(f"g{g}w{r.randrange(3000)}" for _ in range(length))
        texts += [base] + [edited(r, base, r.choice([0.005, 0.01, 0.02, 0.04])) for _ in range(of)]
    return texts + [" ".join(f"u{r.randrange(9000)}" for _ in range(60)) for _ in range(150)]


def test_buckets_are_bits_of_fingerprints_and_lose_few_pairs():
    r, mixers = np.random.default_rng(1), n._mixers()
    pairs = []
    for _ in range(3000):  # 160 of 180 hashes in common: a similarity of 0.8
        x = r.integers(0, 1 << 63, 200).astype(np.uint64)
        pairs += [n.fingerprint(x[:180], mixers), n.fingerprint(x[20:], mixers)]
    fps = np.array(pairs)
    apart = np.bitwise_count(fps[::2] ^ fps[1::2]).sum(1)
    assert abs(apart.mean() / 256 - n.differing(0.8)) < 0.005 and (apart <= n.reach_of(4, 0.8)).mean() > 0.999
    for nodes in (240_000, 15_000_000):
        bits, keys = n.plan(nodes, 0.8)
        assert nodes / 512 <= 1 << bits < nodes / 256
        met = np.zeros(3000, bool)
        for key in n.buckets(fps, bits, keys):
            met |= key[::2] == key[1::2]
            assert len(np.unique(key)) > min(1 << bits, 3000) // 3
        assert met.mean() > 0.997


def test_small_shards_and_buckets_of_no_task_equal_all_pairs(spark, monkeypatch):
    texts = alike(random.Random(4))
    roots, near = components([shingles(x) for x in texts])
    least = {root: min(i for i, x in enumerate(roots) if x == root) for root in set(roots)}
    want = [(i, least[root]) for i, root in enumerate(roots)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    written = n.written
    monkeypatch.setattr(n, "written", lambda df, name: seen.append((name, df.columns)) or written(df, name))
    assert near > 500
    for crowd, large in ((512, 16384), (8, 16384), (64, 24)):
        monkeypatch.setattr(n, "CROWD", crowd)
        monkeypatch.setattr(n, "LARGE", large)
        assert sorted(map(tuple, near_copies(df).collect())) == want
    assert "wide" in {name for name, _ in seen}
    assert {name for name, columns in seen if "hashes" in columns} == {"sets"}  # of candidates, not of all rows


def test_parities_differ_no_more_than_sets_do():
    r = np.random.default_rng(2)
    for size in (1, 30, 150, 600):
        pool = np.unique(r.integers(0, 1 << 63, 2 * size).astype(np.uint64))
        for share in (0.5, 0.8, 0.95):
            x, y = (np.unique(np.r_[pool[: int(share * size)], r.choice(pool, size)]) for _ in range(2))
            apart = int(np.bitwise_count(n.parities(x) ^ n.parities(y)).sum())
            differing = len(np.setxor1d(x, y))
            assert apart <= differing and (differing - apart) % 2 == 0 and apart >= 0.6 * min(differing, 300)
    assert not n.parities(np.zeros(0, np.uint64)).any()


def test_pairs_of_a_hot_group_grow_with_its_nodes(spark, monkeypatch):
    r = random.Random(6)
    base = " ".join(f"h{r.randrange(3000)}" for _ in range(140))
    texts = [base] + [edited(r, base, r.choice([0.005, 0.02, 0.035, 0.05])) for _ in range(300)]
    roots, _ = components([shingles(x) for x in texts])
    least = {root: min(i for i, x in enumerate(roots) if x == root) for root in set(roots)}
    tried = []
    similar = n.similar
    monkeypatch.setattr(n, "similar", lambda pairs, *rest: tried.append(pairs.count()) or similar(pairs, *rest))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(map(tuple, near_copies(df).collect())) == [(i, least[root]) for i, root in enumerate(roots)]
    assert len(least) > 50 and len(tried) == 2 and sum(tried) < 4 * len(texts)


def test_rows_that_are_equal_stay_once(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, "other words that stand alone here"), (1, "other words that stand alone here"), (2, text), (3, text), (None, text), (None, "a b c"), (None, "a b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(str, map(tuple, p.near_dedup(spark, df, "").collect()))) == sorted(map(str, [rows[0], rows[2], rows[5]]))
