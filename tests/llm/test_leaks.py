import random

import pytest
from pyspark.sql import functions as F

from tessera.llm.leaks import Finder, Index, best_match, decontaminate, find_leaks, words_of


def slow_best(item, text):
    row, best = list(range(len(item) + 1)), len(item)
    for x in text:
        new = [0]
        for i, y in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != y)))
        row, best = new, min(best, new[-1])
    return best


def case(seed, n_docs, n_items):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randint(5, 60)))) for i in range(n_items)]
    docs = []
    for k in range(n_docs):
        text = [r.choice(words) for _ in range(r.randint(5, 120))]
        if k % 2:
            own = r.choice(items)[1].split()
            for _ in range(int(0.2 * len(own))):
                at = r.randrange(len(own))
                own[at : at + r.randint(0, 1)] = [r.choice(words)] * r.randint(0, 1)
            text[r.randrange(len(text)) :] = own
        docs.append((k, " ".join(text)))
    return docs, items


def test_bit_parallel_distance():
    r = random.Random(1)
    for _ in range(300):
        item, text = ([r.randrange(5) for _ in range(n)] for n in (r.randint(1, 70), r.randint(0, 90)))
        assert best_match(item, text)[0] == slow_best(item, text)


def test_recall_against_every_document_and_item():
    docs, items = case(4, 200, 40)
    index = Index(items, 0.8)
    found = {(a, b): d for a, b, _, _, d in Finder(index)([x for _, x in docs])}
    number = lambda x: [index.vocabulary.get(w, 0) for w in words_of(x)]
    true = {(a, b): d for a, (_, x) in enumerate(docs) for b, item in enumerate(index.items) if (d := slow_best(item, number(x))) <= index.edits[b]}
    assert set(found) <= set(true) and all(found[k] == true[k] for k in found)
    assert len(found) >= 0.95 * len(true) > 50


def test_rows_and_passes(spark):
    docs, items = case(5, 60, 12)
    rows = [(k, x, "clash") for k, x in docs] + [(900, None, ""), (901, "", ""), (None, docs[1][1], ""), (1, docs[1][1], "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([*items, (77, None), (78, " ")], "item_id long, text string")
    one = sorted(map(repr, map(tuple, find_leaks(df, bench).collect())))
    assert one == sorted(map(repr, map(tuple, find_leaks(df, bench, block=4).collect()))) and one
    left = decontaminate(df, bench)
    assert left.columns == df.columns
    leaked = {r["doc_id"] for r in find_leaks(df.withColumn("doc_id", F.xxhash64("text")), bench).collect()}
    texts = {r["text"] for r in df.where(F.xxhash64("text").isin(leaked)).collect()}
    assert sorted(map(repr, map(tuple, left.collect()))) == sorted(repr(x) for x in rows if x[1] not in texts) and docs[1][1] in texts
    assert find_leaks(df.limit(0), bench).count() == 0 and find_leaks(df, bench.limit(0)).count() == 0


@pytest.mark.parametrize("low,high,n", [(5, 20, 40), (20, 36, 40), (30, 60, 40), (80, 150, 20), (300, 600, 6)])
@pytest.mark.parametrize("kind", ["insert", "delete", "change", "any"])
def test_recall_at_the_full_share_of_edits(low, high, n, kind):
    """Every kind of edit, a fifth of the item's words; true pairs by the exact distance of all pairs."""
    r = random.Random(f"{low} {kind}")
    words = [f"w{i}" for i in range(2000)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randint(low, high)))) for i in range(n)]
    docs = []
    for _, x in items:
        own = x.split()
        for _ in range(int(0.2 * len(own) + 1e-9)):
            what = r.choice(["insert", "delete", "change"]) if kind == "any" else kind
            at = r.randrange(len(own))
            own[at : at + (what != "insert")] = [] if what == "delete" else [r.choice(words)]
        around = [[r.choice(words) for _ in range(r.randint(0, 40))] for _ in range(2)]
        docs.append(" ".join(around[0] + own + around[1]))
    index = Index(items, 0.8)
    found = {(a, b): d for a, b, _, _, d in Finder(index)(docs)}
    number = [[index.vocabulary.get(w, 0) for w in words_of(x)] for x in docs]
    true = {(a, b): d for a, x in enumerate(number) for b, item in enumerate(index.items) if len(set(item) & set(x)) >= (len(item) - index.edits[b]) / 2 and (d := slow_best(item, x)) <= index.edits[b]}
    assert len(true) >= n and set(found) <= set(true) and all(found[k] == true[k] for k in found)
    assert len(found) >= 0.9 * len(true)
