import math
import random
import zlib
from collections import Counter

import pytest

from tessera.llm.langid import Scorer, held_out, identify, train, words_of


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = identify(docs, train(docs, per_language=60)).withColumn("out", held_out()).collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    tested = [r for r in rows if r["out"]]
    assert len(tested) > 150 and sum(r["lang"] == r["lang_pred"] for r in tested) / len(tested) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_backoff_by_hand(spark):
    docs = spark.createDataFrame([(k, x, lang) for k in range(1, 60) for x, lang in (("stone river stone", "en"), ("fluss stein fluss", "de"))], "doc_id long, text string, lang string")
    model = train(docs)
    assert model.languages == ["de", "en"] and "stone" in model.known[0]
    seen = model.rows_of("stones")
    assert "stones" not in model.known[0] and model.known[4]["^sto"] in seen and model.known[1]["e"] not in seen
    assert Scorer(model, most=1)(["Stone!", "stein", "stones flusse", None, "", "123 ..."])[3:] == [("und", 0.0)] * 3


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, "en", 0.5), (2, "", None, 0.5), (None, "river", "en", 0.5), (4, "word " * 50_000, "en", 0.5)], "doc_id long, text string, lang string, score double")
    found = identify(docs, train(docs)).collect()
    assert len(found) == 4 and {r["lang_pred"] for r in found} <= {"en", "und"}
    nothing = train(docs.limit(0))
    assert {r["lang_pred"] for r in identify(docs, nothing).collect()} == {"und"}
    assert identify(docs.limit(0), nothing).count() == 0


def slow(docs):
    """A plain model and scorer over whole texts: doc_id to (language, probability)."""
    usable = [(lang, text) for k, text, lang in docs if lang is not None and text is not None and zlib.crc32(str(k).encode()) % 5]
    langs = sorted({x for x, _ in usable})
    counts = {}
    for lang, text in usable:
        for word in words_of(text):
            marked = f"^{word}$"
            for key in [(0, word), *((n, marked[i : i + n]) for n in (1, 2, 3, 4) for i in range(len(marked) - n + 1))]:
                counts.setdefault(key, Counter())[lang] += 1
    counts = {k: kept for k, x in counts.items() if (kept := {lang: n for lang, n in x.items() if n > 1})}
    sizes = {(lang, n): sum(x.get(lang, 0) for (m, _), x in counts.items() if m == n) + 0.5 * sum(m == n for m, _ in counts) for lang in langs for n in range(5)}
    log = lambda key, lang: math.log((counts[key].get(lang, 0) + 0.5) / sizes[lang, key[0]])

    def word_score(word, lang):
        if (0, word) in counts:
            return log((0, word), lang)
        marked = f"^{word}$"
        longest = [next(((n, marked[i : i + n]) for n in (4, 3, 2, 1) if len(marked[i : i + n]) == n and (n, marked[i : i + n]) in counts), None) for i in range(max(1, len(marked) - 3))]
        found = [log(x, lang) for x in longest if x]
        return sum(found) / len(found) if found else 0.0

    out = {}
    for k, text, _ in docs:
        words = words_of(text or "")
        logs = [math.log(sum(x == lang for x, _ in usable) / len(usable)) + sum(word_score(w, lang) for w in words) for lang in langs]
        best = max(range(len(langs)), key=lambda i: logs[i]) if words else None
        out[k] = (langs[best], 1 / sum(math.exp(x - logs[best]) for x in logs)) if words else ("und", 0.0)
    return out


def test_scores_equal_the_plain_scorer(spark):
    r = random.Random(4)
    roots = {"aa": ["stone", "river", "light", "under"], "bb": ["stein", "fluss", "licht", "unter"], "cc": ["pierre", "fleuve", "lumière", "sous"]}
    make = lambda lang: "".join(r.choice([r.choice(roots[lang]), r.choice("abc") + r.choice(roots[lang])[1:], r.choice(roots[lang]) + "s"]))
    docs = [(k, " ".join(make(lang) for _ in range(r.randint(1, 6))), r.choice([lang, lang, None])) for k in range(150) for lang in [r.choice(list(roots))]]
    docs += [(200, None, "aa"), (201, "", "bb"), (202, "12 34 !", None), (203, "qqq zzzzz x", None), (204, "Stone, RIVER-light fluss", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    want = slow(docs)
    for row in identify(df, train(df)).collect():
        lang, score = want[row["doc_id"]]
        assert row["score"] == pytest.approx(score, rel=2e-3, abs=1e-9) and (row["lang_pred"] == lang or 0.4 < score < 0.6)
