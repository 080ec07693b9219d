"""Operator 6: benchmark items in documents, up to edits of words.

Texts become sequences of words. A CGK walk maps a sequence to a string of fixed length: at step j
it puts out its current word, and moves on by a random bit that hangs on j and that word alone. Two
sequences a small edit distance apart meet again after each edit, so their strings differ in few
places. Each walk is sampled at SAMPLES of its steps; a window of a document and an item that agree
on all samples of a walk are candidates, and each candidate is then checked by its exact edit
distance over words. How many walks a class of lengths gets is measured when the index is built: the
fewest that find RECALL of pieces of its items after all edits that count, whatever their kind.

Windows are as long as the items of their class (classes a tenth wide), and begin at every word. An
item of more than LONGEST words is sought by its pieces: with E edits in k pieces, some piece has
E // k at most, which keeps the share of edits, and strings do not drift apart over hundreds of
steps. What is checked is the whole item.

Windows that cannot match are passed over first, and no other ones. A piece of n words with at most
d edits keeps n - d of them, in d + 1 runs at most; so a window must hold so many words of the
benchmark, and one run of ceil((n - d) / (d + 1)) words of some item.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, runs, written

SAMPLES = 2
#: The share of a class's edited pieces that its walks must find, and walks at most.
RECALL, MOST_TABLES = 0.95, 96
#: Words of an item that is one piece.
LONGEST = 36
#: Items that tasks get to know at once, about; more are looked for in further passes.
BLOCK = 10_000
_MIX = 0x9E3779B97F4A7C15
_EDGE = re.compile(r"[\W_]+")


def word_of(piece: str) -> str:
    """A piece between white space as a word: lower case, letters and digits only (may be empty)."""
    return _EDGE.sub("", piece.lower())


def words_of(text: str | None) -> list[str]:
    return [x for x in map(word_of, (text or "").split()) if x]


def best_match(item: list[int], text: list[int]) -> tuple[int, int]:
    """The least edit distance between the item and any part of the text, and where the first such part ends (bit-parallel)."""
    n = len(item)
    places: dict[int, int] = {}
    for i, x in enumerate(item):
        places[x] = places.get(x, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    more, less, score = full, 0, n
    best, end = n, 0
    for j, x in enumerate(text, 1):
        eq = places.get(x, 0)
        across = (((eq & more) + more) ^ more) | eq
        up, down = less | (full & ~(across | more)), more & across
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) & full, (down << 1) & full
        eq |= less
        more, less = down | (full & ~(eq | up)), up & eq
        if score < best:
            best, end = score, j
    return best, end


def edited(words: list[int], n: int, kind: int, other: int, rng) -> list[int]:
    """words after n edits: insertions (kind 0), deletions (1), changes (2) or any (3), with words from ``other`` on as new ones."""
    out = list(words)
    for k in range(n):
        what = kind if kind < 3 else int(rng.integers(3))
        at = int(rng.integers(len(out) + (what == 0))) if out or what == 0 else 0
        out[at : at + (what != 0)] = [] if what == 1 else [other + k]
    return out


class Index:
    """Items, with the samples of their walks by class of lengths."""

    def __init__(self, items: list[tuple], similarity: float, samples: int = SAMPLES, recall: float = RECALL, seed: int = 5):
        """items: (item_id, text). Items without words are left out."""
        import numpy as np

        self.vocabulary: dict[str, int] = {}
        self.names, self.items = [], []
        for name, text in items:
            words = words_of(text)
            if words:
                self.names.append(name)
                self.items.append([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in words])
        self.sets = [np.unique(x) for x in self.items]
        self.edits = [int((1 - similarity) * len(x) + 1e-9) for x in self.items]
        self.samples, self.recall = samples, recall
        rng = np.random.default_rng(seed)
        self.end = len(self.vocabulary) + 1  # the symbol past a window's end; 0 is a word of no item
        self.salt = rng.integers(0, 1 << 64, MOST_TABLES, np.uint64)
        self.times = rng.integers(0, 1 << 63, (2 * LONGEST, MOST_TABLES), np.uint64) * np.uint64(2) + np.uint64(1)
        self.plus = rng.integers(0, 1 << 64, (2 * LONGEST, MOST_TABLES), np.uint64)
        longest = max(map(len, self.items), default=1)
        self.pad = longest + 2 * max(self.edits, default=0) + 1
        todo: list[tuple[int, int, int, int]] = []  # pieces: words, edits, item, where it begins there
        for i, x in enumerate(self.items):
            k = 1 if len(x) <= LONGEST else round(len(x) / 24)
            size = len(x) // k
            todo += [(size, self.edits[i] // k, i, j * size) for j in range(k)]
        todo.sort()
        self.classes = []
        while todo:
            floor = todo[0][0]
            mine = [x for x in todo if x[0] <= max(floor, int(1.1 * floor))]
            todo = todo[len(mine) :]
            self.classes.append(self._class(floor, mine, rng))

    def _class(self, floor: int, mine: list[tuple[int, int, int, int]], rng) -> dict:
        import numpy as np

        steps = np.zeros((2 * floor, MOST_TABLES), bool)
        part = 2 * floor / self.samples
        for t in range(MOST_TABLES):  # a step in each part: steps next to each other often put out one word
            steps[np.floor(rng.random() * part + part * np.arange(self.samples)).astype(int), t] = True
        pieces = [self.items[i][at : at + size] for size, _, i, at in mine]
        steps = steps[:, : self._enough(floor, pieces, max(e for _, e, *_ in mine), steps, rng)]
        known = np.zeros(self.end + 1, bool)
        for x in pieces:
            known[x] = True
        run = min(-(-(size - e) // (e + 1)) for size, e, *_ in mine)
        run = max(1, min(run, floor))
        grams = np.unique(np.concatenate([self.grams(np.array(x), run) for x in pieces]))
        keys = self.walk(np.array([x[:floor] for x in pieces]), steps)
        flat, who = keys.ravel(), np.repeat(np.arange(len(mine)), steps.shape[1])
        order = np.argsort(flat, kind="stable")
        most = max(e for _, e, *_ in mine)
        reach = max(size for size, *_ in mine) + most
        item, begin = (np.array([x[k] for x in mine]) for k in (2, 3))
        return {"floor": floor, "steps": steps, "known": known, "run": run, "grams": grams, "keys": flat[order], "items": item[who[order]], "begins": begin[who[order]], "least": floor - most, "reach": reach}

    def _enough(self, floor: int, pieces: list[list[int]], edits: int, steps, rng) -> int:
        """How many walks find the share of edited pieces, for the kind of edits that needs most."""
        import numpy as np

        if not edits:
            return 1
        need = 1
        chosen = [pieces[int(i)] for i in rng.integers(len(pieces), size=150)]
        own = self.walk(np.array([x[:floor] for x in chosen]), steps)
        for kind in range(4):
            texts = [edited(x, edits, kind, self.end + 1, rng) + list(range(self.end + 100, self.end + 100 + floor)) for x in chosen]
            same = self.walk(np.array([x[:floor] for x in texts]), steps) == own
            first = np.sort(np.where(same.any(1), same.argmax(1), MOST_TABLES))
            need = max(need, int(first[int(np.ceil(self.recall * len(first))) - 1]) + 1)
        return min(need, MOST_TABLES)

    def grams(self, words, run: int):
        import numpy as np

        out = np.zeros(max(0, len(words) - run + 1), np.uint64)
        for k in range(run):
            out = (out ^ words[k : k + len(out)].astype(np.uint64)) * np.uint64(_MIX)
            out ^= out >> np.uint64(29)
        return out

    def walk(self, windows, steps):
        """The key of each window in each table: a hash of the table and its sampled symbols."""
        import numpy as np

        (n, floor), tables = windows.shape, steps.shape[1]
        flat = np.concatenate([windows, np.full((n, 1), self.end)], axis=1).astype(np.uint64).ravel()
        begin = np.arange(n)[:, None] * (floor + 1)
        at = np.zeros((n, tables), np.int64)
        keys = np.broadcast_to(self.salt[:tables], (n, tables)).copy()
        for j in range(int(np.flatnonzero(steps.any(1)).max()) + 1):
            here = flat[begin + np.minimum(at, floor)]
            own = steps[j]
            if own.any():
                mixed = (keys[:, own] ^ here[:, own]) * np.uint64(_MIX)
                keys[:, own] = mixed ^ (mixed >> np.uint64(31))
            at += ((here * self.times[j, :tables] + self.plus[j, :tables]) >> np.uint64(63)).astype(np.int64)
        return keys

    def candidates(self, flat) -> set[tuple[int, int]]:
        """(place, item) in a sequence of word ids; an item of several pieces may begin before the sequence does."""
        import numpy as np

        out: set[tuple[int, int]] = set()
        for c in self.classes:
            n, run = len(flat) - c["floor"] + 1, c["run"]
            if n <= 0:
                continue
            known = c["known"][flat]
            upto = np.concatenate([[0], np.cumsum(known, dtype=np.int32)])
            dense = upto[c["floor"] :] - upto[:-c["floor"]] >= c["least"]
            # places where a run of an item begins
            whole = np.flatnonzero(upto[run:] - upto[:-run] == run)
            hashes = np.zeros(len(whole), np.uint64)
            for k in range(run):
                hashes = (hashes ^ flat[whole + k].astype(np.uint64)) * np.uint64(_MIX)
                hashes ^= hashes >> np.uint64(29)
            i = np.minimum(np.searchsorted(c["grams"], hashes), len(c["grams"]) - 1)
            hit = np.zeros(len(flat) + 1, np.int32)
            hit[whole[c["grams"][i] == hashes] + 1] = 1
            hits = np.cumsum(hit, dtype=np.int32)
            far = np.minimum(np.arange(n) + c["reach"], len(flat))
            places = np.flatnonzero(dense & (hits[far] > hits[:n]))
            for part in range(0, len(places), 20_000):
                own = places[part : part + 20_000]
                keys = self.walk(flat[own[:, None] + np.arange(c["floor"])], c["steps"])
                low, high = np.searchsorted(c["keys"], keys), np.searchsorted(c["keys"], keys, "right")
                for r, t in zip(*np.nonzero(high > low)):
                    place = int(own[r])
                    found = slice(low[r, t], high[r, t])
                    out.update(zip((place - c["begins"][found]).tolist(), c["items"][found].tolist()))
        return out


class Finder:
    """Finds an index's items in texts; keeps the word of each piece, up to ``most`` pieces."""

    def __init__(self, index: Index, most: int = 300_000):
        self.index, self.most, self.kept = index, most, {}

    def __call__(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word, words, distance) of each text and item within the item's edits; the nearest and first place of each."""
        import numpy as np

        index, kept = self.index, self.kept
        if len(kept) > self.most:
            kept.clear()
        pieces = [x.split() for x in texts]
        for x in set().union(*pieces) - kept.keys():
            word = word_of(x)
            kept[x] = index.vocabulary.get(word, 0) if word else -1
        own = []
        for x in pieces:
            ids = np.fromiter(map(kept.__getitem__, x), np.int32, len(x))
            own.append(ids[ids >= 0])
        gap = np.zeros(index.pad, np.int32)
        flat = np.concatenate([y for x in own for y in (x, gap)]) if own else gap
        begins = np.cumsum([0, *(len(x) + index.pad for x in own)])
        spans: dict[tuple[int, int], list[int]] = {}
        found = sorted(index.candidates(flat))
        owner = np.searchsorted(begins - index.pad, [x for x, _ in found], "right") - 1  # a gap before a text is its own
        for (place, item), text in zip(found, owner.tolist()):
            spans.setdefault((text, item), []).append(place - int(begins[text]))
        out = []
        for (text, item), places in sorted(spans.items()):
            words, most = index.items[item], index.edits[item]
            found = None
            places.sort()
            k = 0
            while k < len(places):  # places near each other are checked as one
                first = last = places[k]
                while k < len(places) and places[k] <= last + 2 * most + 1:
                    last = places[k]
                    k += 1
                low = max(0, first - most)
                near = own[text][low : max(0, last + len(words) + 2 * most)]
                if np.count_nonzero(np.isin(near, index.sets[item])) < len(words) - most:
                    continue  # too few of the item's words
                part = near.tolist()
                distance, end = best_match(words, part)
                if distance <= most and (found is None or distance < found[2]):
                    _, back = best_match(words[::-1], part[:end][::-1])
                    found = (low + end - back, back, distance)
            if found:
                out.append((text, item, *found))
        return out


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", similarity: float = 0.8, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """Which items are in which documents: doc_id, item_id, start, n_words, distance, similarity.

    An item of n words is in a document if some part of it is within (1 - similarity) * n edits of
    words (insertions, deletions, changes); start is that part's first word and n_words its length,
    for the nearest part, of equal ones the first to end. A row for each document row and item,
    also of equal ids; null or wordless texts and items have none. Documents are read where they
    lie, once for each ``block`` items (by hash, so about as many), and not shuffled. With several
    passes each one's rows are written before the next begins, so that the driver has one index.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    wanted = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    passes = -(-max(1, wanted.count()) // block)
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))

    def within(k: int) -> DataFrame:
        mine = wanted.where(dealt == k) if passes > 1 else wanted
        shared = spark.sparkContext.broadcast(Index([tuple(r) for r in mine.collect()], similarity, recall=recall))

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = Finder(shared.value)
            index = finder.index
            for batch in batches:
                names, texts = batch.column(0), batch.column(1).to_pylist()
                for part in runs([len(x) for x in texts], 1 << 21):
                    found = finder(texts[part])
                    if found:
                        text, item, start, n, distance = zip(*found)
                        ids = names.take(pa.array([x + part.start for x in text]))
                        near = [1 - d / len(index.items[i]) for d, i in zip(distance, item)]
                        yield pa.RecordBatch.from_arrays([ids, pa.array([index.names[i] for i in item], pa.int64()), pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(distance, pa.int32()), pa.array(near, pa.float64())], ["doc_id", "item_id", "start", "n_words", "distance", "similarity"])

        return arrow_map(rows, find, "doc_id long, item_id long, start int, n_words int, distance int, similarity double")

    if passes == 1:
        return within(0)
    return reduce(DataFrame.unionByName, [written(within(k), "leaks") for k in range(passes)])


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, with all their columns, whose text holds no item.

    Rows are told apart by a hash of id and text: one without an id goes too if it holds an item,
    and one that shares its id with another row stays if it holds none. Other arguments are
    find_leaks()'s.
    """
    keyed = docs.withColumn("_row", F.xxhash64(F.col(id_col), F.col(text_col)))
    found = find_leaks(keyed, items, "_row", text_col, **options).select(F.col("doc_id").alias("_leaked")).distinct()
    return keyed.join(found, F.col("_row") == F.col("_leaked"), "left_anti").drop("_row")
