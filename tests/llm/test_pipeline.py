import random

import corpus_pipeline as p


def test_stages_keep_what_plain_python_keeps(spark, tmp_path):
    r = random.Random(8)
    words = [f"{a}{b}{c}" for a in ("st", "riv", "gar") for b in ("one", "er", "den", "il") for c in ("ing", "ed", "ly", "s")]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, item = text(60), text(30)
    clean = [(k, text(150), "en") for k in range(40)]
    rows = [*clean, (100, clean[5][1], "en"), (101, clean[6][1] + " more", "en"), (102, text(80) + "\n" + passage, "en"), (103, text(80) + "\n" + passage, "en"), (104, f"{text(50)} {item} {text(50)}", "en"), (105, None, "en"), (106, "12 34", None)]
    spark.createDataFrame([(*x, "src", len(x[1] or "")) for x in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {x["doc_id"]: x["text"] for x in docs.collect()}
    assert set(kept["language_id"]) == {x[0] for x in rows} - {105, 106}
    assert 100 not in kept["line_dedup"] and passage in kept["line_dedup"][102] and passage not in kept["line_dedup"][103]
    assert set(kept["near_dedup"]) == set(kept["line_dedup"]) - {101}
    assert set(kept["decontamination"]) == set(kept["near_dedup"]) - {104} and {x[0] for x in clean} <= set(kept["decontamination"])
    out = p.run(spark, str(tmp_path)).collect()
    assert {x["doc_id"] for x in out} == set(kept["decontamination"])
    assert sum(x["length"] for x in out) == sum({x["doc_id"]: x["doc_tokens"] for x in out}.values())


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert p.run(spark, str(tmp_path)).count() == 0
