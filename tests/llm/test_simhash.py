import math
import random
import time

import numpy as np
import pytest
import xxhash

from tessera.llm.simhash import SHARD, Tree, _buckets, blocks_for, components, drop_near_duplicates, fingerprint, linked, links, near_duplicates


def slow_fingerprint(text, n=4):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(x, seed=42) for x in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(fps, reach):
    up = {x: x for x in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= reach:
                up[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in fps}


def near(r, n):
    """Fingerprints with chains and a dense group."""
    out = [r.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        x = r.choice(out[: n // 4] + out[-8:])
        for _ in range(r.randint(1, 5)):
            x ^= 1 << r.randrange(64)
        out.append(x)
    return sorted(set(out))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints():
    for text in ("", "one", "One Two", "a b c d", "Çe A\tb c d e f g", "x y " * 200):
        assert fingerprint(text.encode(), 4) == slow_fingerprint(text)


def test_tree_regions_hold_every_near_pair():
    r = random.Random(1)
    fps = near(r, 300)
    array = np.array(fps, np.uint64)
    tree = Tree(fps[::3], 6)
    where = {i: set() for i in range(len(fps))}
    for i, region in zip(*(x.tolist() for x in tree.shards(array, 6, 4))):
        where[i].add(region)
    for i, a in enumerate(fps):
        for j in range(i):
            assert (a ^ fps[j]).bit_count() > 4 or where[i] & where[j]


def test_links_connect_what_is_near(spark):
    r = random.Random(2)
    fps = near(r, 400)
    want = roots(fps, 4)
    assert len({want[a] for a, _ in linked(np.array(fps, np.uint64), 4)}) <= len(set(want.values()))
    nodes = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    for shard in (4, SHARD):
        edges = links(nodes, 4, shard=shard, sample=256)
        found = {row["node"]: row["root"] for row in components(edges).collect()}
        groups = {}
        for x in fps:
            groups.setdefault(found.get(signed(x), signed(x)), set()).add(want[x])
        assert all(len(x) == 1 for x in groups.values()) and len(groups) == len(set(want.values()))


@pytest.mark.parametrize("n,m", [(10**5, 5), (10**6, 6), (10**9, 7), (10**11, 8)])
def test_near_fingerprints_share_a_bucket(n, m):
    r = random.Random(n)
    fps = np.array([r.getrandbits(64) for _ in range(300)], np.uint64)
    near = fps.copy()
    for _ in range(4):
        near ^= np.array([1 << r.randrange(64) for _ in fps], np.uint64)
    assert blocks_for(n, 4) == m
    pairs = list(zip(_buckets(fps, 4, m), _buckets(near, 4, m)))
    assert len(pairs) == math.comb(m, 4) and np.any([a == b for a, b in pairs], axis=0).all()


def test_a_level_of_the_tree_deals_all_and_some_to_both_sides():
    r = random.Random(4)
    fps = np.array([r.getrandbits(64) for _ in range(500)], np.uint64)
    who, at = Tree(fps[:100].tolist(), 5).shards(fps, 1, 4)
    assert set(who.tolist()) == set(range(500)) and set(at.tolist()) == {1, 2} and 1.3 * 500 < len(who) < 2 * 500


def test_a_dense_group_takes_no_square_of_its_size():
    r = random.Random(6)
    center = r.getrandbits(64)
    fps = set()
    while len(fps) < 60_000:
        x = center
        for _ in range(r.randint(1, 6)):
            x ^= 1 << r.randrange(64)
        fps.add(x)
    begin = time.time()
    assert len(linked(np.array(sorted(fps), np.uint64), 4)) == len(fps) - 1 and time.time() - begin < 30


def test_rows(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(9, base), (4, base), (2, base + " more"), (7, None), (8, ""), (5, "lone text of its own"), (None, base), (5, "lone text of its own")]
    df = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, component_id string")
    found = near_duplicates(df).collect()
    fps = {x: slow_fingerprint(x or "") for _, x in rows}
    want = roots(sorted(set(fps.values())), 4)
    least = {}
    for k, x in rows:
        if k is not None:
            least[want[fps[x]]] = min(k, least.get(want[fps[x]], k))
    assert sorted(map(repr, map(tuple, found))) == sorted(repr((k, f"{fps[x]:016x}", least[want[fps[x]]])) for k, x in rows)
    assert sorted(x["doc_id"] for x in drop_near_duplicates(df).collect()) == sorted(k for k, x in rows if k is not None and least[want[fps[x]]] == k)
    assert near_duplicates(df.limit(0)).count() == 0
