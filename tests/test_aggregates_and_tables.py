import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera import Engine, TableStream
from tessera.operators.aggregate import Callbacks


def test_partial_states_merge(spark):
    e = Engine(spark)
    e.register_aggregate("gather", ["i64"], "varchar", update=lambda s, x: (s or []) + [x], combine=lambda a, b: a + b, copy=list, finalize=lambda s: "none" if s is None else ",".join(map(str, sorted(s))))
    df = spark.range(0, 60, 1, 5).select((F.col("id") % 3).alias("k"), F.expr("CASE WHEN id % 3 = 2 THEN NULL ELSE id END").alias("x"))
    rows = dict(map(tuple, e.aggregate(df, ["k"], "gather", "x").collect()))
    assert rows == {0: ",".join(map(str, range(0, 60, 3))), 1: ",".join(map(str, range(1, 60, 3))), 2: "none"}
    assert rows == dict(map(tuple, df.groupBy("k").agg(e.agg("gather", "x")).collect()))
    assert [tuple(r) for r in e.aggregate(df.limit(0), [], "gather", "x").collect()] == [("none",)]
    assert df.limit(0).agg(e.agg("gather", "x"), F.count("*")).first()[0] == "none"
    nulls = df.withColumn("k", F.expr("nullif(k, 1)"))
    assert e.aggregate(nulls, ["k"], "gather", "x").where("k IS NULL").first()[1] == rows[1]


def test_chunk_callbacks_come_first():
    seen = []

    def chunk(states, groups, xs):
        seen.append(groups)
        return [(s or 0) + sum(x for g, x in zip(groups, xs) if g == i + 1) for i, s in enumerate(states)]

    calls = Callbacks(update=lambda s, x: 1 / 0, update_chunk=chunk, finalize=lambda s: s, combine_chunk=lambda a, b: [x + y for x, y in zip(a, b)], copy_chunk=lambda s: [x * 10 for x in s])
    assert calls.folded([None, 5], [1, 2, 0, 1], [(1,), (2,), (100,), (3,)]) == [4, 7] and seen == [[1, 2, 0, 1]]
    assert calls.merged(None, 4) == 40 and calls.merged(3, 4) == 7 and calls.merged(None, None) is None
    with pytest.raises(RuntimeError, match="update"):
        Callbacks(update=lambda s, x: 1 / 0, finalize=abs).folded([None], [1], [(1,)])
    with pytest.raises(RuntimeError, match="combine"):
        Callbacks(update=max, finalize=abs, combine=lambda a, b: 1 / 0).merged(1, 2)


def test_aggregate_results_are_checked(spark):
    e = Engine(spark)
    e.register_aggregate("bad", ["i64"], "i32", update=lambda s, x: x, finalize=lambda s: 3.7)
    with pytest.raises(Exception, match="TypeError"):
        spark.range(3).agg(e.agg("bad", "id")).collect()
    with pytest.raises(ValueError, match="combine"):
        e.aggregate(spark.range(3), [], "bad", "id")


def test_finite_tables(spark):
    e = Engine(spark)
    e.register_table("pair", lambda n, s: {"i": [n, n + 1], "s": [s, None]})
    want = [(3, "a"), (4, None)]
    assert [tuple(r) for r in e.table("pair", 3, "a").collect()] == want == [tuple(r) for r in spark.sql("SELECT * FROM pair(1 + 2, 'a')").collect()]
    for bad in ({}, {"a": [1], "b": [1, 2]}, {"": [1]}, pa.table([[1], [2]], names=["a", "a"])):
        e.register_table("bad_table", _returns(bad))
        with pytest.raises((ValueError, TypeError)):
            e.table("bad_table")
    with pytest.raises(TypeError):
        e.table("pair", 1)
    with pytest.raises(Exception):  # noqa: B017
        spark.sql("SELECT * FROM pair(1)").collect()


def _returns(value):
    return lambda: value


def stream(batches, closed, **more):
    left = list(batches)
    return TableStream({"i": [0]}, lambda: left.pop(0) if left else None, close=lambda: closed.write_text(closed.read_text() + "x"), **more)


@pytest.mark.parametrize(("batches", "more", "error"), [([{"i": [1, 2, 3]}, {"i": [4]}], {}, None), ([{"i": [1]}], {"cardinality": 1, "exact": True}, None), ([{"i": [1]}], {"cardinality": 2, "exact": True}, "promised"), ([{"i": [1, 2, 3]}], {"cardinality": 2, "exact": True}, "promised"), ([{"i": []}], {}, "row at least|column i"), ([{"j": [1]}], {}, "columns"), ([{"i": ["a"]}], {}, "prototype"), ([], {}, None)])
def test_streams(spark, tmp_path, batches, more, error):
    closed = tmp_path / "closed"
    closed.write_text("")
    e = Engine(spark)
    e.register_table("streamed", lambda: stream(batches, closed, **more), chunk_size=2)
    if error:
        with pytest.raises(Exception, match=error):
            e.table("streamed").collect()
    else:
        assert [r["i"] for r in e.table("streamed").collect()] == [x for b in batches for x in b["i"]]
    assert closed.read_text() == "x"


def test_a_limit_closes_a_stream(spark, tmp_path):
    closed = tmp_path / "closed"
    closed.write_text("")
    e = Engine(spark)
    e.register_table("long_one", lambda: TableStream({"i": [0]}, lambda n: {"i": [1] * n}, close=lambda: closed.write_text(closed.read_text() + "x")))
    assert e.table("long_one").limit(3).count() == 3
    end = time.time() + 30  # the worker learns that no more is needed when the driver has its rows already
    while not closed.read_text() and time.time() < end:
        time.sleep(0.05)
    time.sleep(0.2)
    assert closed.read_text() == "x"


def test_result_streams(spark):
    e = Engine(spark)
    s = e.query_stream("SELECT id AS i, id * 1.5D AS x, concat('v', id) AS s, named_struct('a', id) AS r FROM range(1, 6000)", batch_rows=1000)
    assert s.schema[:3] == [("i", "bigint"), ("x", "double"), ("s", "string")]
    sizes, total = [], 0
    while (batch := s.next_batch()) is not None:
        sizes.append(batch.num_rows)
        total += sum(batch["i"].to_pylist())
    assert sum(sizes) == 5999 and max(sizes) == 1000 and total == 5999 * 3000
    s.close()
    assert s.next_batch() is None
    other = e.query_stream(spark.range(5))
    assert e.stats()["open_streams"] == 1
    e.release()
    assert other.next_batch() is None and e.stats()["open_streams"] == 0


def test_functions_over_file_streams(spark, tmp_path, sf_dir):
    from tessera.streaming.results import to_table, windowed_counts

    e = Engine(spark)
    e.register_scalar("kind_of", lambda x: x.upper(), ["varchar"], "varchar")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in").withColumn("event_type", e.call("kind_of", "event_type"))
    to_table(source.select("event_id", "event_type"), f"{tmp_path}/out", f"{tmp_path}/at")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == sorted((r["event_id"], r["event_type"].upper()) for r in events.collect())
    assert windowed_counts(source, "ts", "event_type", "value").isStreaming


def test_registered_aggregates_gather_no_group_in_a_row(spark, sf_dir):
    from tessera.queries import QUERIES

    for name in ("agg_sum_rowwise", "agg_filter", "agg_rollup", "agg_cube"):
        assert "collect_list" not in QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()


def test_partial_states_with_filter_and_grouping_sets(spark, engine):
    from pyspark.sql import functions as F

    engine.register_aggregate("sum_parts", ["i64"], "i64", update=lambda s, x: (s or 0) + x, finalize=lambda s: s, combine=lambda a, b: a + b)
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "x", 4), (None, "x", 8)], "k string, m string, v long")
    assert {tuple(r) for r in engine.aggregate(df, ["k"], "sum_parts", "v", where=F.col("v") < 3).collect()} == {("a", 3), ("b", None), (None, None)}
    found = engine.aggregate(df, ["k", "m"], "sum_parts", "v", alias="s", sets=[["k", "m"], ["k"], []])
    want = df.rollup("k", "m").agg(F.sum("v").alias("s"))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, map(tuple, want.collect())))


def test_keys_are_equal_where_group_by_has_them_equal(spark):
    from pyspark.sql import functions as F

    e = Engine(spark)
    e.register_aggregate("sum_keys", ["i64"], "i64", update=lambda s, x: (s or 0) + x, finalize=lambda s: s, combine=lambda a, b: a + b)
    df = spark.range(0, 240, 1, 6).select("id", F.when(F.col("id") % 4 == 0, float("nan")).when(F.col("id") % 4 == 1, -0.0).when(F.col("id") % 4 == 2, 0.0).alias("x"))
    df = df.withColumns({"s": F.struct("x", F.array("x").alias("inner")), "l": F.array("x")})
    want = sorted(r[1] for r in df.groupBy("x").agg(F.sum("id")).collect())
    for key in ("x", "s", "l"):
        assert sorted(r[1] for r in e.aggregate(df, [key], "sum_keys", "id").collect()) == want and len(want) == 3
    assert sorted(r[1] for r in e.aggregate(df.select((F.col("id") % 2).alias("k"), (F.col("id") % 5).alias("v")), ["k"], "sum_keys", "v", distinct=True).collect()) == [10, 10]


def test_without_keys_the_partial_stage_has_the_tasks_of_the_scan(spark):
    e = Engine(spark)
    e.register_aggregate("sum_all", ["i64"], "i64", update=lambda s, x: (s or 0) + x, finalize=lambda s: s, combine=lambda a, b: a + b)
    found = e.aggregate(spark.range(0, 100, 1, 5), [], "sum_all", "id")
    assert found.first()[0] == 4950
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "Exchange" in plan


def test_closing_a_result_stream_ends_its_job(spark):
    e = Engine(spark)
    e.register_scalar("slow_one", lambda x: time.sleep(0.2) or x, ["i64"], "i64")
    s = e.query_stream(spark.range(0, 4000, 1, 400).select(e.call("slow_one", "id")), batch_rows=5)
    assert s.next_batch().num_rows == 5
    s.close()
    end = time.time() + 30
    while e.stats()["active_jobs"] and time.time() < end:
        time.sleep(0.1)
    assert not e.stats()["active_jobs"]


@pytest.mark.parametrize("rows", [(-1, 0), (-3, -2), (0, 2), (1, 3), (-2, 2), (-70, 70)])
@pytest.mark.parametrize("special", [False, True])
def test_window_equals_plain_frames(spark, rows, special):
    nan = float("nan")
    keys = [None, nan, -0.0, 0.0, 1.5]
    table = [(keys[i * 7 % 5], i, None if i % 6 == 0 else i) for i in range(300)]
    e = Engine(spark)
    e.register_aggregate("frame", ["i64"], "varchar", null_handling="special" if special else "default", update=lambda s, x: [*(s or []), x], finalize=lambda s: "none" if s is None else repr(s))
    df = spark.createDataFrame(table, "k double, i long, x long")
    parts = {}
    for k, i, x in table:
        parts.setdefault("nan" if k != k else k, []).append((i, x))
    want = []
    for part in parts.values():
        for at, (i, _) in enumerate(part):
            frame = [x for _, x in part[max(0, at + rows[0]) : max(0, at + rows[1] + 1)] if special or x is not None]
            want.append((i, repr(frame) if frame else "none"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = e.window(df, "frame", "x", partition=["k"], order=["i"], rows=rows).select("i", "frame").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(map(tuple, found)) == sorted(want)


@pytest.mark.parametrize("special", [False, True])
def test_sql_lists_of_rows_equal_sql_name(spark, special):
    e = Engine(spark)
    seen = {"null_handling": "special" if special else "default", "update": lambda s, *x: [*(s or []), x], "finalize": lambda s: "none" if s is None else repr(sorted(s, key=repr))}
    e.register_aggregate("seen_two", ["i64", "varchar"], "varchar", **seen)
    e.register_aggregate("seen_one", ["i64"], "varchar", **seen)
    spark.range(200).selectExpr("id % 9 AS k", "IF(id % 9 = 4 OR id % 7 = 0, NULL, id) AS x", "IF(id % 5 = 0, NULL, CAST(id AS STRING)) AS s").createOrReplaceTempView("seen_rows")
    name = spark.sql("SELECT k, seen_two(x, s) AS v FROM seen_rows GROUP BY k").collect()
    lists = spark.sql("SELECT k, seen_two_rows(collect_list(struct(x, s))) AS v FROM seen_rows GROUP BY k").collect()
    assert sorted(map(tuple, name)) == sorted(map(tuple, lists)) and (special or (4, "none") in map(tuple, lists))
    if not special:
        name = spark.sql("SELECT k, seen_one(x) AS v FROM seen_rows GROUP BY k").collect()
        lists = spark.sql("SELECT k, seen_one_rows(collect_list(x)) AS v FROM seen_rows GROUP BY k").collect()
        assert sorted(map(tuple, name)) == sorted(map(tuple, lists))
    assert spark.sql("SELECT seen_one_rows(CAST(NULL AS ARRAY<BIGINT>)), seen_one_rows(CAST(array() AS ARRAY<BIGINT>))").first()[:] == ("none", "none")
