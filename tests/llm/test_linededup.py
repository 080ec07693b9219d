import random
import time

import pytest

from tessera.llm.linededup import _lines, dedup_lines, named_runs


def slow(docs, least):
    """Lines of each document that lie in a run of enough words that occurred before."""
    texts = {k: (v or "").split("\n") for k, v in docs}
    seen, gone = set(), {k: set() for k in texts}
    weight = lambda run: sum(max(1, len(x.split())) for x in run)
    for k in sorted(texts):
        own = texts[k]
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                run = tuple(own[a:b])
                if weight(run) >= least:
                    if run in seen:
                        gone[k].update(range(a, b))
                    seen.add(run)
    return {k: "\n".join(x for i, x in enumerate(own) if i not in gone[k]) for k, own in texts.items()}


@pytest.mark.parametrize(("seed", "least"), [(1, 4), (2, 7), (3, 1), (4, 12)])
def test_against_all_runs(spark, seed, least):
    r = random.Random(seed)
    lines = ["a", "b\tc", "d  e\u3000f", "", "g h i\xa0j k", "l", " m n "]
    docs = [(k, "\n".join(r.choice(lines) for _ in range(r.randint(1, 14)))) for k in range(25)]
    docs += [(50, docs[3][1]), (51, docs[3][1] + "\nb c"), (52, "")]
    df = spark.createDataFrame([(*x, 9) for x in docs], "doc_id long, text string, deleted_lines int")
    found = {x["doc_id"]: x["text"] for x in dedup_lines(df, least=least).collect()}
    assert found == slow(docs, least)


def test_edge_rows(spark):
    long = "\n".join(f"line {i} of a long text with words" for i in range(3000))
    rows = [(1, None), (None, long), (2, long), (2, long), (3, "x")]
    found = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(x["doc_id"]), x["text"] if x["text"] is None else len(x["text"])) for x in found) == sorted([("1", None), ("None", len(long)), ("2", 0), ("2", 0), ("3", 1)])
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_many_lines_in_one_document(spark):
    """Linear in the lines: what compares each line with each deleted one takes minutes here."""
    text = "\n".join(f"line {i} of a text" for i in range(100_000))
    rows = [(1, text), (2, text), (3, "\n".join(["same"] * 200_000))]
    begin = time.time()
    found = {x["doc_id"]: (x["deleted_lines"], len(x["text"])) for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: (0, len(text)), 2: (100_000, 0), 3: (199_999, 4)} and time.time() - begin < 100


def test_names_are_intervals_of_the_prefix_array(spark):
    """Of a plain suffix array with longest common prefixes: places share a name just if they share its interval."""
    r = random.Random(9)
    docs = [(k, "\n".join(r.choice("ab") for _ in range(r.randint(4, 30)))) for k in range(20)]
    df = spark.createDataFrame([(k, k, 0, x) for k, x in docs], "doc_id long, h1 long, h2 long, text string")
    runs = [(x["doc_id"], x["line"], x["n"], (x["own"], x["other"])) for x in named_runs(df, 5).collect()]
    suffixes = sorted((x.split("\n")[i:], k, i) for k, x in docs for i in range(len(x.split("\n"))))
    common = [0] + [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for (a, *_), (b, *_) in zip(suffixes, suffixes[1:])]
    place = {(k, i): at for at, (_, k, i) in enumerate(suffixes)}
    interval = {}
    for k, i, n, name in runs:
        low = place[k, i]
        while common[low] >= n:
            low -= 1
        interval.setdefault((n, name), set()).add(low)
    assert all(len(x) == 1 for x in interval.values()) and len(runs) > 200
    assert len({(n, min(x)) for (n, _), x in interval.items()}) == len(interval)


def test_words_of_lines(spark):
    lines = ["", " ", "a", "a b", " a", "a ", "a  b", "a\tb c", "\ta", "a\xa0b", "a\u3000b\u2003c", "ä b", "a\r", "a\x0bb", "x y z"]
    texts = [*lines, "a b\nc", "a b\n c", "a b \nc", "\n", "a\nb\n"]
    df = spark.createDataFrame([(k, k, 0, x) for k, x in enumerate(texts)], "doc_id long, h1 long, h2 long, text string")
    found = {(x["doc_id"], x["line"]): x["words"] for x in _lines(df).collect()}
    assert found == {(k, i): max(1, len(x.split())) for k, t in enumerate(texts) for i, x in enumerate(t.split("\n"))}
