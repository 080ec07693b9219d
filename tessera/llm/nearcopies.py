"""Operator 10 at a similarity: SimHash fingerprints and vantage points find pairs, sets of shingles decide.

A text's set holds the hashes of its runs of words, and its fingerprint is the SimHash of that set:
a bit is 1 if over half the hashes have it. Rows of equal sets are one node. Sets with a Jaccard
similarity of s differ in a share of acos(2 s / (1 + s)) / pi of bits, 0.15 at 0.8: 9.7 of 64. So many
are beyond what 64 bits can deal, so fingerprints are WORDS64 times as wide here, each word the
SimHash of other hashes of the same runs, and a node goes to one bucket for each of several choices of bits,
by their values. As many bits are chosen as make buckets of CROWD unrelated nodes, and as many
choices as leave MISSED of the pairs at that similarity without a common bucket (see plan()). Pairs
within a bucket that agree in as many bits as all but few in 100,000 such pairs do are checked: a
link counts only if the sets' similarity is at least ``least``, exactly.

A bucket's nodes are ordered by their distance from its vantage point, the node nearest to the
majority of the bucket's in each bit; by the triangle inequality partners lie within the reach
before or after. A bucket with few pairs gives them all. One with many holds a group of texts that
are alike: stars about nodes, the nearest to the vantage point first, give pairs that connect most,
and of its nodes that have partners each pair within reach that is then still apart is checked if its
sets can be that similar: their parities (see parities()) tell most that are not, without a miss. A
bucket so large that no task should have it is not gathered: its vantage point is found by sums, and
all are checked against that. No bucket is cut short.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, partitions, passing, scratch, stored, written
from .simhash import components, majority

#: 64-bit words of a fingerprint, and those that a row in a bucket has.
WORDS64, CARRIED = 4, 2
#: 64-bit words of a set's parities.
PARITY64 = 16
#: Unrelated nodes of a bucket, about; nodes of a bucket that is not gathered in a task.
CROWD, LARGE = 512, 16_384
#: Share of the pairs at the least similarity that have no bucket in common.
MISSED = 0.0005
#: Deviations by which a pair's bits may differ more than the mean: 1 in 100,000 pairs do.
SHORT = 4.4
#: Pairs for each node of a bucket that are listed, and for each with partners that are given, at most.
MANY, GIVEN = 8, 2
#: Nodes from which sizes of buckets are estimated.
COUNTED = 200_000
#: Pairs of one node that a copy of its set serves.
SERVED = 256

_FP = [f"f{i}" for i in range(WORDS64)]
_PARITY = [f"p{i}" for i in range(PARITY64)]


def differing(least: float) -> float:
    """The share of bits in which fingerprints of sets with that similarity, of like size, differ."""
    return math.acos(2 * least / (1 + least)) / math.pi


def plan(nodes: int, least: float) -> tuple[int, int]:
    """Bits of a key, and keys of a node."""
    total, p = 64 * WORDS64, differing(least)
    bits = min(40, max(1, math.ceil(math.log2(max(1, nodes) / CROWD))))
    shares = [(math.comb(total, d) * p**d * (1 - p) ** (total - d), math.comb(total - d, bits) / math.comb(total, bits)) for d in range(total + 1)]
    keys = 1
    while sum(share * (1 - found) ** keys for share, found in shares) > MISSED:
        keys += 1
    return bits, keys


def reach_of(words64: int, least: float) -> int:
    """Bits in which the first words of the fingerprints of a link may differ."""
    n, p = 64 * words64, differing(least)
    return round(n * p + SHORT * math.sqrt(n * p * (1 - p)))


def shingles(text: bytes, words: int):
    """The hashes of the runs of words of the lower-case (A-Z) text, distinct and sorted; a shorter text is one run."""
    import numpy as np
    import xxhash

    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    runs = map(b" ".join, zip(*(found[i:] for i in range(words)))) if len(found) >= words else [b" ".join(found)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(x, 42) for x in runs), np.uint64))


def _mixers():
    import numpy as np

    r = np.random.default_rng(5)
    return r.integers(0, 1 << 63, WORDS64, np.uint64) * np.uint64(2) + np.uint64(1)


def fingerprint(hashes, mixers):
    """The WORDS64 words of the set's SimHash: bit i is set if over half the hashes, mixed anew for each word, have it."""
    import numpy as np

    mixed = hashes[:, None] * mixers
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    lanes = np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little").view(np.uint64)  # 8 bits in the 8 bytes of each
    counts = np.zeros(64 * WORDS64, np.int64)
    for i in range(0, len(hashes), 255):
        counts += lanes[i : i + 255].sum(0, dtype=np.uint64).view(np.uint8)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)


def parities(hashes):
    """The PARITY64 words of the set's parities: bit i is set if an odd number of its hashes are i in their last bits.

    A hash that one of two sets lacks changes one bit, so no more bits differ than hashes do.
    """
    import numpy as np

    counts = np.bincount((hashes & np.uint64(64 * PARITY64 - 1)).astype(np.int64), minlength=64 * PARITY64)
    return np.packbits((counts & 1).astype(bool), bitorder="little").view(np.uint64)


def buckets(fps, bits: int, keys: int) -> Iterator:
    """The key of each bucket of each fingerprint (rows of WORDS64 words): the values of ``bits`` bits, for each choice of them."""
    import numpy as np

    r = np.random.default_rng(7)
    each = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(len(fps), -1), axis=1, bitorder="little").T.astype(np.int64)
    for k in range(keys):
        key = np.full(len(fps), k, np.int64)
        for i in r.choice(64 * WORDS64, bits, replace=False).tolist():
            key = key * 2 + each[i]
        yield key


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(text_col, F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def sketches(rows: DataFrame, words: int, with_sets: bool = False) -> DataFrame:
    """doc_id, text_key, node (a digest of the set), its size and the words of its fingerprint and parities, a row for each row; or node and hashes (the set)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        mixers = _mixers()
        for batch in batches:
            sets = [shingles(x.as_py(), words) for x in batch.column(2).cast(pa.binary())]
            nodes = pa.array(np.array([xxhash.xxh64_intdigest(x.tobytes(), 1) for x in sets], np.uint64).view(np.int64))
            if with_sets:
                yield pa.RecordBatch.from_arrays([nodes, pa.array([x.tobytes() for x in sets], pa.binary())], ["node", "hashes"])
                continue
            fps = np.array([fingerprint(x, mixers) for x in sets], np.uint64).reshape(-1, WORDS64).view(np.int64)
            odd = np.array([parities(x) for x in sets], np.uint64).reshape(-1, PARITY64).view(np.int64)
            sizes = pa.array([len(x) for x in sets], pa.int64())
            columns = [pa.array(x[:, i].copy()) for x in (fps, odd) for i in range(x.shape[1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), nodes, sizes, *columns], ["doc_id", "text_key", "node", "size", *_FP, *_PARITY])

    words64 = "".join(f", {x} long" for x in _FP + _PARITY)
    return arrow_map(rows, each, "node long, hashes binary" if with_sets else f"doc_id long, text_key long, node long, size long{words64}")


def dealt(nodes: DataFrame, bits: int, keys: int) -> DataFrame:
    """key, node and the carried words: a row for each bucket of each node."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            if not batch.num_rows:
                continue
            fps = np.stack([batch.column(1 + i).to_numpy() for i in range(WORDS64)], axis=1)
            carried = [batch.column(i) for i in range(1 + CARRIED)]
            for key in buckets(fps, bits, keys):
                yield pa.RecordBatch.from_arrays([pa.array(key), *carried], ["key", "node", *_FP[:CARRIED]])

    return nodes.select("node", *_FP).mapInArrow(deal, "key long, node long" + "".join(f", {x} long" for x in _FP[:CARRIED]))


def _apart(fps, others):
    """Differing bits of fingerprints (arrays of words)."""
    import numpy as np

    return sum(np.bitwise_count(x ^ y).astype(np.int16) for x, y in zip(fps, others))


def by_vantage_point(fps):
    """The order of fingerprints by their distance from the one nearest to the majority in each bit, and the distances in that order."""
    import numpy as np

    middle = [np.uint64(majority(x)) for x in fps]
    nearest = int(_apart(fps, middle).argmin())
    away = _apart(fps, [x[nearest] for x in fps])
    order = np.argsort(away, kind="stable")
    return order, away[order]


def close_pairs(fps, word: int, reach: int, most: int):
    """Indexes of all pairs within ``reach`` bits, ``word`` in the first word; None if they are more than ``most``."""
    import numpy as np

    order, away = by_vantage_point(fps)
    fps = [x[order] for x in fps]
    left, right, n = [], [], 0
    for i in range(0, len(order), 64):
        end = int(np.searchsorted(away, away[min(i + 63, len(away) - 1)] + reach, "right"))
        a, b = np.nonzero(np.bitwise_count(fps[0][i : i + 64, None] ^ fps[0][None, i:end]) <= word)
        after = b > a
        a, b = a[after] + i, b[after] + i
        near = _apart([x[a] for x in fps], [x[b] for x in fps]) <= reach
        n += int(near.sum())
        if n > most:
            return None
        left.append(order[a[near]])
        right.append(order[b[near]])
    return np.concatenate(left), np.concatenate(right)


def stars(fps, radius: int):
    """Pairs of a node and all others, not yet in a star, within ``radius`` bits of it; those near the vantage point have theirs first."""
    import numpy as np

    free, _ = by_vantage_point(fps)
    left, right = [], []
    while len(free):
        near = _apart([x[free] for x in fps], [x[free[0]] for x in fps]) <= radius
        left.append(np.full(int(near.sum()) - 1, free[0]))
        right.append(free[near][1:])
        free = free[~near]
    return np.concatenate(left), np.concatenate(right)


def _search(least: float):
    word, reach, mean = reach_of(1, least), reach_of(CARRIED, least), round(64 * CARRIED * differing(least))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches are sorted by key; the last bucket of a batch may go on in the next. Pairs (a, b, null), and (null, key, node) for the nodes with partners of a bucket of which not all pairs are given."""
        import numpy as np

        kept: list[tuple] = []

        def done(keys, nodes, *fps) -> pa.RecordBatch:
            fps = [x.view(np.uint64) for x in fps]
            edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]).tolist()
            one, two, crowded, alike = [nodes[:0]], [nodes[:0]], [nodes[:0]], [nodes[:0]]
            for a, b in zip(edges, edges[1:]):
                if b - a < 2:
                    continue
                own = [x[a:b] for x in fps]
                pairs = close_pairs(own, word, reach, MANY * (b - a))
                among = np.arange(b - a) if pairs is None else np.unique(np.concatenate(pairs))
                if pairs is None or len(pairs[0]) > GIVEN * len(among):
                    pairs = [among[x] for x in stars([x[among] for x in own], mean)]
                    crowded.append(np.full(len(among), keys[a]))
                    alike.append(nodes[a:b][among])
                one.append(nodes[a:b][pairs[0]])
                two.append(nodes[a:b][pairs[1]])
            x, y, crowded, alike = (np.concatenate(v) for v in (one, two, crowded, alike))
            none = pa.nulls(len(x), pa.int64()), pa.nulls(len(alike), pa.int64())
            first = pa.concat_arrays([pa.array(np.minimum(x, y)), none[1]]), pa.array(np.concatenate([np.maximum(x, y), crowded]))
            return pa.RecordBatch.from_arrays([*first, pa.concat_arrays([none[0], pa.array(alike)])], ["a", "b", "node"])

        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(tuple(x.to_numpy() for x in batch.columns))
            if kept[0][0][0] == kept[-1][0][-1]:
                continue  # one bucket so far
            whole = [np.concatenate(x) for x in zip(*kept)]
            cut = int(np.searchsorted(whole[0], whole[0][-1]))
            yield done(*(x[:cut] for x in whole))
            kept = [tuple(x[cut:].copy() for x in whole)]
        if kept:
            yield done(*(np.concatenate(x) for x in zip(*kept)))

    return search


def _with_set(pairs: DataFrame, sets: DataFrame, side: str) -> DataFrame:
    """pairs with that side's set; the set of a node of many pairs is copied, so that no task gets them all."""
    many = F.broadcast(pairs.groupBy(side).count().where(F.col("count") > SERVED).select(side, F.ceil(F.col("count") / SERVED).cast("int").alias("copies")))
    dealt = pairs.join(many, side, "left").withColumn("copy", F.pmod(F.xxhash64("a", "b"), F.coalesce("copies", F.lit(1))).cast("int")).drop("copies")
    own = sets.select(F.col("node").alias(side), F.col("hashes").alias(f"set_{side}")).join(many, side, "left")
    own = own.withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")
    return dealt.join(own, [side, "copy"]).drop("copy")


def similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sets have that Jaccard similarity at least, exactly."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if min(len(x), len(y)) < least * max(len(x), len(y)):
                    good.append(False)
                    continue
                both = np.concatenate([x, y])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                good.append(shared >= least * (len(both) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    whole = _with_set(_with_set(pairs, sets, "a"), sets, "b").select("a", "b", "set_a", "set_b")
    return whole.mapInArrow(check, "a long, b long")


#: Rows that a join may broadcast.
FEW = 1_000_000


def few(df: DataFrame) -> DataFrame:
    """df, broadcast where it is joined if it has few rows."""
    return F.broadcast(df) if df.count() <= FEW else df


def sets_of(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """node and hashes of the nodes of pairs, from their texts, as sets of all rows would be larger than the table."""
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "text_key"), "node"), "wanted")
    texts = rows.join(few(wanted.select("text_key").distinct()), "text_key", "left_semi").select("doc_id", "text_key", "text")
    return written(sketches(texts, words, True).join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")


def _bits_apart(x: str, y: str, words: list[str]):
    return reduce(lambda a, b: a + b, (F.bit_count(F.col(f"{x}{w}").bitwiseXOR(F.col(f"{y}{w}"))) for w in words))


def vantage_stars(single: DataFrame, reach: int) -> DataFrame:
    """Pairs (a, b) of each bucket's vantage point and all within ``reach`` of it; single: key, node and the carried words.

    Counts of bits are summed before the shuffle, so a bucket that holds a third of all nodes is no hot key.
    """
    names = _FP[:CARRIED]
    bits = single.groupBy("key").agg(F.count("*").alias("n"), *(F.sum(F.getbit(x, F.lit(i)).cast("int")).alias(f"{x}_{i}") for x in names for i in range(64)))
    word = lambda x: reduce(lambda a, b: a.bitwiseOR(b), (F.when(F.col(f"{x}_{i}") * 2 > F.col("n"), F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")) for i in range(64)))
    middles = written(bits.select("key", *(word(x).alias(f"m_{x}") for x in names)), "middles")
    nearest = F.min(F.struct(_bits_apart("", "m_", names).alias("away"), "node", *names)).alias("c")
    centers = written(single.join(middles, "key").groupBy("key").agg(nearest).select("key", F.col("c.node").alias("center"), *(F.col(f"c.{x}").alias(f"c_{x}") for x in names)), "centers")
    near = single.join(centers, "key").where((F.col("node") != F.col("center")) & (_bits_apart("", "c_", names) <= reach))
    return near.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b"))


def left_apart(crowd: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) within reach, and of sizes and parities that allow the similarity, of which the nodes have different roots; crowd: key, node, size and all words.

    Sets of that similarity differ in (1 - least) / (1 + least) of the hashes of both at most.
    """
    within = written(crowd.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed")
    groups = within.groupBy("key", "root").count().groupBy("key").agg(F.max_by("root", F.struct("count", "root")).alias("main"), F.count("*").alias("n"))
    mains = written(groups.where("n > 1").select("key", "main"), "mains")
    one = within.join(mains, "key").where("root <> main")
    one, two = (df.select("key", *extra, *(F.col(x).alias(f"{side}{x}") for x in ("node", "root", "size", *_FP, *_PARITY))) for df, side, extra in ((one, "x_", ["main"]), (within, "y_", [])))
    near = F.least("x_size", "y_size") >= F.lit(least) * F.greatest("x_size", "y_size")
    for n in (1, CARRIED, WORDS64):
        near &= _bits_apart("x_", "y_", _FP[:n]) <= reach_of(n, least)
    near &= _bits_apart("x_", "y_", _PARITY) <= (F.col("x_size") + F.col("y_size")) * F.lit((1 - least) / (1 + least) + 1e-9)
    once = (F.col("y_root") == F.col("main")) | (F.col("x_node") < F.col("y_node"))
    pairs = one.join(two, "key").where((F.col("x_root") != F.col("y_root")) & once & near)
    return pairs.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: float = 0.8) -> DataFrame:
    """doc_id and component_id, the smallest doc_id reachable over links; a row for each row.

    A text of fewer words than a run is one run; null texts and texts without words are one node.
    Null ids are passed over as component ids, unless a component has no other.
    """
    spark = docs.sparkSession
    rows = _rows(docs, id_col, text_col)
    sketched = written(sketches(rows, words), "sketches")
    nodes = written(sketched.groupBy("node").agg(F.min("doc_id").alias("least"), *(F.min(x).alias(x) for x in ("text_key", "size", *_FP, *_PARITY))), "nodes")
    total = nodes.count()
    bits, keys = plan(total, least)
    everywhere = gathered = dealt(nodes, bits, keys)
    large = None
    if total > LARGE:
        rate = min(1.0, COUNTED / total)
        some = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < int((1 << 30) * rate))
        large = written(dealt(some, bits, keys).groupBy("key").count().where(F.col("count") > LARGE * rate).select("key"), "large")
        large = None if large.isEmpty() else large
    if large is not None:
        gathered = everywhere.join(few(large), "key", "left_anti")
    found = written(gathered.repartition(partitions(spark), "key").sortWithinPartitions("key").mapInArrow(_search(least), "a long, b long, node long"), "found")
    first, crowd = found.where("a is not null").select("a", "b"), found.where("a is null").select(F.col("b").alias("key"), "node")
    if large is not None:
        wide = written(everywhere.join(few(large), "key", "left_semi"), "wide")
        first, crowd = first.union(vantage_stars(wide, reach_of(CARRIED, least))), crowd.union(wide.select("key", "node"))
    tried = written(first.distinct(), "pairs")
    links = written(similar(tried, sets_of(tried, nodes, rows, words), least), "links")
    roots = components(links)
    crowd = written(crowd, "crowd")
    if not crowd.isEmpty():
        second = written(left_apart(crowd.join(nodes.select("node", "size", *_FP, *_PARITY), "node"), roots, least).join(tried, ["a", "b"], "left_anti"), "pairs")
        more = written(similar(second, sets_of(second, nodes, rows, words), least), "links")
        if not more.isEmpty():
            roots = components(links.union(more))
    placed_nodes = written(nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")), "rooted")
    named = written(placed_nodes.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    whole = written(placed_nodes.join(named, "root").select("node", "component_id"), "whole")
    return sketched.select("doc_id", "node").join(whole, "node").select("doc_id", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of docs, with all their columns, of the smallest id of each component of near_copies().

    Rows are told apart by a hash of id and text, so that of two texts of one id only one stays if
    they are near; rows equal in both are one row. Of rows with one id the smallest hash stays, and
    a row with a null id only if its component has no other.
    """
    keyed = docs.withColumn("_row", F.xxhash64(F.col(id_col), F.col(text_col)))
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("_row").alias("row"))
    path = scratch(docs.sparkSession, "kept")
    with passing(docs.sparkSession):
        found = written(near_copies(keyed, "_row", text_col, words, least).groupBy("doc_id", "component_id").agg(F.count("*").alias("n")), "found")
        ids = keyed.select("_row", order.alias("o")).join(found, F.col("_row") == F.col("doc_id")).groupBy("component_id").agg(F.min("o").alias("o")).select(F.col("o.row").alias("_kept"))
        stays = F.col("_kept").isNotNull()
        marked = stored(found.join(ids, F.col("doc_id") == F.col("_kept"), "left").where(~stays | (F.col("n") > 1)).select(F.col("doc_id").alias("_row"), stays.alias("stays")), path)
    once = keyed.join(few(marked.select("_row")), "_row", "left_anti")
    again = keyed.join(few(marked.where("stays").select("_row")), "_row", "left_semi").dropDuplicates(["_row"])
    return once.unionByName(again).drop("_row")
