"""Operator 10: SimHash near-duplicates, found by vantage-point trees over fingerprints.

A tree parts fingerprints into shards: each node by whether they are within its radius of its
vantage point. By the triangle inequality a fingerprint's partners lie beyond the boundary only if
its own distance is within r of the radius; so each goes to every shard whose region comes that
near, and exact pairs are sought within shards, where distances to a vantage point prune by the same
bound.

Distances of unrelated 64-bit fingerprints gather at 32 bits, 68 % of them within 4 of it, so each
level of a tree sends those both ways: a tree alone is no way to make shards small. Two fingerprints
within r bits agree on at least m - r of m blocks of bits, so what the tree parts are buckets of
fingerprints that agree on m - r blocks, one for each choice of the blocks. m grows with the number of
fingerprints (copies of each: 5 buckets up to 0.5 million, 15 up to 134 million, 35 up to 9 billion), so
that unrelated ones are few in a bucket and work grows with the input, not with its square. Each
bucket is parted by the tree at one level at least; one that is larger than a shard by more.

Links are reported as a spanning forest, not as all pairs of a group. Components are then joined
across shards by iterated minima over written tables.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, discard, partitions, scratch, written

BITS = 64
#: Fingerprints that the tree is built from, at most; it has at most as many nodes.
SAMPLE = 4096
#: Fingerprints that a shard should have, at most; and that a bucket has of unrelated ones, about.
SHARD, CROWD = 512, 64
#: Fingerprints from which sizes of buckets are estimated.
COUNTED = 1_000_000
#: Levels that part a large bucket, at most: a dense group goes both ways at most of them.
LEVELS = 6
#: Buckets whose size tasks get to know, at most.
BUCKETS = 100_000
_MIX = 0x9E3779B97F4A7C15


def fingerprint(text: bytes, words: int) -> int:
    """Of the whole text: bit i is set if over half the shingles' hashes have it."""
    import numpy as np
    import xxhash

    found = text.lower().split()  # of bytes: A-Z, and white space of ASCII
    if not found:
        return 0
    shingles = map(b" ".join, zip(*(found[i:] for i in range(words)))) if len(found) >= words else [b" ".join(found)]
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(x, 42) for x in shingles), np.uint64))


def majority(hashes) -> int:
    """Bit i is set if over half the hashes have it; of none, 0."""
    import numpy as np

    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long), a row for each row.

    Shingles are runs of ``words`` words, repeats included, of the lower-case (A-Z) text; a shorter
    text is one shingle, and a null text or one without words has fingerprint 0. Other columns are
    not read.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            texts = batch.column(1).fill_null("").cast(pa.binary())
            fps = np.array([fingerprint(x.as_py(), words) for x in texts], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(rows, each, "doc_id long, fp long")


class Tree:
    """A vantage-point tree in arrays: node i's halves are nodes 2 i + 1 (within its radius) and 2 i + 2."""

    def __init__(self, sample: list[int], levels: int, seed: int = 1):
        import numpy as np

        r = random.Random(seed)
        n = (1 << levels) - 1
        self.levels = levels
        self.points, self.radii = np.zeros(n, np.uint64), np.full(n, BITS // 2 - 1, np.int64)
        parts: list = [None] * (2 * n + 1)
        parts[0] = np.array(sample, np.uint64)
        for i in range(n):
            mine = parts[i]
            self.points[i] = mine[r.randrange(len(mine))] if len(mine) else r.getrandbits(BITS)
            d = np.bitwise_count(mine ^ self.points[i]).astype(np.int64)
            if len(mine):
                self.radii[i] = min(int(np.median(d)), max(0, int(d.max()) - 1))
            parts[2 * i + 1], parts[2 * i + 2] = mine[d <= self.radii[i]], mine[d > self.radii[i]]

    def shards(self, fps, levels: int, reach: int):
        """For each fingerprint, all regions at that level which come within ``reach`` of it: (index into fps, region)."""
        import numpy as np

        who, at = np.arange(len(fps)), np.zeros(len(fps), np.int64)
        for _ in range(min(levels, self.levels)):
            d = np.bitwise_count(fps[who] ^ self.points[at]).astype(np.int64) - self.radii[at]
            near, far = d <= reach, d > -reach
            who, at = np.concatenate([who[near], who[far]]), np.concatenate([2 * at[near] + 1, 2 * at[far] + 2])
        return who, at


def blocks_for(n: int, reach: int) -> int:
    """Into how many blocks the bits are cut, so that n unrelated fingerprints make buckets of CROWD at most."""
    m = reach + 1
    while m < BITS // 4 and n > CROWD << BITS * (m - reach) // m:
        m += 1
    return m


def _buckets(fps, reach: int, m: int):
    """The key of each bucket of each fingerprint: the values of m - reach of m blocks of bits, for each choice of them."""
    import numpy as np

    edges = [BITS * i // m for i in range(m + 1)]
    values = [(fps >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1) for low, high in zip(edges, edges[1:])]
    for k, chosen in enumerate(combinations(values, m - reach), 1):
        key = np.full(len(fps), k, np.uint64)
        for v in chosen:
            key = (key ^ v) * np.uint64(_MIX)
            key ^= key >> np.uint64(29)
        yield key


def linked(fps, reach: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between distinct fingerprints: each once reached, from the one that reached it.

    Candidates are first cut to those whose distance to a vantage point differs by at most ``reach``.
    """
    import numpy as np

    if len(fps) < 2:
        return []
    away = np.bitwise_count(fps ^ fps[0])
    order = np.argsort(away, kind="stable")
    points, away = fps[order], away[order].astype(np.int64)
    out, todo, free = [], [], np.ones(len(points), bool)
    left = len(points)
    while left:
        if 2 * left < len(points):  # what is reached is no longer looked at: a dense group takes no square of its size
            points, away, free = points[free], away[free], np.ones(left, bool)
        if not todo:
            i = int(free.argmax())
            free[i] = False
            left -= 1
            todo.append((points[i], int(away[i])))
        point, d = todo.pop()
        low, high = np.searchsorted(away, [d - reach, d + reach + 1]).tolist()
        near = low + np.flatnonzero(free[low:high] & (np.bitwise_count(points[low:high] ^ point) <= reach))
        free[near] = False
        left -= len(near)
        out += [(int(point), int(x)) for x in points[near]]
        todo += zip(points[near], away[near].tolist())
    return out


def _pairs_of_small(fps, group, reach: int):
    """Links between fingerprints of equal group, for sorted groups of few."""
    import numpy as np

    left, right = [], []
    for step in range(1, len(fps)):
        same = group[step:] == group[:-step]
        if not same.any():
            break
        i = np.flatnonzero(same)
        i = i[np.bitwise_count(fps[i] ^ fps[i + step]) <= reach]
        left.append(fps[i])
        right.append(fps[i + step])
    return (np.concatenate(left), np.concatenate(right)) if left else (fps[:0], fps[:0])


_SMALL = 24


def _search(reach: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches are sorted by shard; the last shard of a batch may go on in the next."""
        import numpy as np

        kept: list[tuple] = []

        def done(keys, fps) -> pa.RecordBatch:
            edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
            sizes = np.diff(edges)
            small = np.repeat(sizes <= _SMALL, sizes)
            left, right = _pairs_of_small(fps[small], keys[small], reach)
            more = [x for a, b in zip(edges[:-1][sizes > _SMALL].tolist(), edges[1:][sizes > _SMALL].tolist()) for x in linked(fps[a:b], reach)]
            a = np.concatenate([left, np.array([x for x, _ in more], np.uint64)]).view(np.int64)
            b = np.concatenate([right, np.array([x for _, x in more], np.uint64)]).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)))
            if kept[0][0][0] == kept[-1][0][-1]:
                continue  # one shard so far
            keys, fps = (np.concatenate(x) for x in zip(*kept))
            cut = int(np.searchsorted(keys, keys[-1]))
            yield done(keys[:cut], fps[:cut])
            kept = [(keys[cut:], fps[cut:])]
        if kept:
            yield done(*(np.concatenate(x) for x in zip(*kept)))

    return search


def links(nodes: DataFrame, reach: int, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Links (a, b) between distinct fingerprints of ``nodes`` (column fp) within ``reach`` bits, a < b.

    Not all of them: enough that whatever is linked is connected. ``sample`` fingerprints at most,
    chosen by hash, make the tree; its depth in a bucket follows the bucket's size, so that shards
    of unrelated fingerprints have ``shard`` or fewer. Sizes of buckets are estimated from COUNTED
    fingerprints, chosen by hash; the driver and the tasks get those above ``shard`` only, and of
    these the BUCKETS largest. A wrong estimate makes a shard larger or smaller, and no link is lost.
    """
    import numpy as np

    spark = nodes.sparkSession
    total = nodes.count()
    m = blocks_for(total, reach)
    dealt_by = F.pmod(F.xxhash64("fp"), F.lit(1 << 30))
    chosen = nodes.where(dealt_by < int((1 << 30) * min(1.0, sample / 2 / max(1, total)))).limit(sample)
    points = [r["fp"] & ((1 << BITS) - 1) for r in chosen.collect()]
    tree = Tree(points, max(1, (len(points) // 4).bit_length()))

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key in _buckets(batch.column(0).to_numpy().view(np.uint64), reach, m):
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["bucket"])

    rate = min(1.0, COUNTED / max(1, total))
    some = nodes.where(dealt_by < int((1 << 30) * rate)).select("fp").mapInArrow(bucket, "bucket long")
    sizes = some.groupBy("bucket").count().where(F.col("count") > shard * rate).orderBy(F.desc("count"), "bucket").limit(BUCKETS)
    large = sorted((r["bucket"] & ((1 << 64) - 1), min(LEVELS, max(1, int(-(-r["count"] // (shard * rate)) - 1).bit_length()))) for r in sizes.collect())
    shared = spark.sparkContext.broadcast((tree, np.array([k for k, _ in large], np.uint64), np.array([n for _, n in large], np.int64)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, keys, levels = shared.value
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for key in _buckets(fps, reach, m):
                depth = np.ones(len(fps), np.int64)
                if len(keys):
                    i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    depth = np.where(keys[i] == key, levels[i], depth)
                for n in np.unique(depth).tolist():
                    mine = np.flatnonzero(depth == n)
                    who, at = tree.shards(fps[mine], n, reach)
                    who = mine[who]
                    shards = (key[who] + at.view(np.uint64)) * np.uint64(_MIX)
                    yield pa.RecordBatch.from_arrays([pa.array(shards.view(np.int64)), pa.array(fps[who].view(np.int64))], ["shard", "fp"])

    dealt = nodes.select("fp").mapInArrow(deal, "shard long, fp long")
    grouped = dealt.repartition(partitions(spark), "shard").sortWithinPartitions("shard")
    return grouped.mapInArrow(_search(reach), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable, for all nodes of the links (a, b).

    Each round a node takes the smallest root of its neighbours, and then that root's root; rounds
    are written, and go on until one changes nothing. Their number grows with the logarithm of the
    longest chain. Minima are taken before the shuffle, so a node of many links is no hot key.
    """
    spark = edges.sparkSession
    both = written(edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(edges.select("b", "a")), "edges")
    roots = written(both.groupBy(F.col("x").alias("node")).agg(F.least(F.col("node"), F.min("y")).alias("root")), "roots")
    while True:
        near = both.join(roots.withColumnRenamed("node", "y"), "y").groupBy(F.col("x").alias("node")).agg(F.min("root").alias("near"))
        best = roots.join(near, "node").select("node", F.least("root", "near").alias("to"), F.col("root").alias("was"))
        path = scratch(spark, "hooked")
        best.write.parquet(path)
        hooked = spark.read.schema(best.schema).parquet(path)
        up = hooked.select(F.col("node").alias("to"), F.col("to").alias("up"))
        jumped = written(hooked.join(up, "to", "left").select("node", F.least("to", F.coalesce("up", "to")).alias("root"), "was"), "roots")
        changed = jumped.where(F.col("root") != F.col("was")).limit(1).count()
        roots = jumped.select("node", "root")
        discard(spark, path)
        if not changed:
            return roots


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, reach: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable over links of ``reach`` bits.

    A row for each row; rows of one id and different texts are linked by their fingerprints alone.
    Null ids are passed over as component ids, unless a component has no other. All links are found
    (see links()): no bucket is cut short. Copies are one fingerprint, counted before the shuffle.
    """
    spark = docs.sparkSession
    marked = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes, reach))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "rooted")
    named = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    whole = written(rooted.join(named, "root").select("fp", "component_id"), "whole")
    joined = marked.join(whole, "fp")
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, reach: int = 4) -> DataFrame:
    """The rows of docs, with all their columns, of the smallest id of each component of near_duplicates().

    Rows of one id stay or go together; rows with a null id stay only if their component has no other.
    """
    found = near_duplicates(docs, id_col, text_col, words, reach)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept.hint("merge"), F.col(id_col).eqNullSafe(F.col("_kept")), "left_semi")
