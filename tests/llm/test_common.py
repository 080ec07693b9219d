import pytest
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, in_order, opened, qualified, shared_dir


def test_a_shared_folder_is_a_whole_uri(spark):
    for named, want in (("/user/ck", "file:///user/ck"), ("file:/x/", "file:///x"), ("file:///y", "file:///y")):
        assert qualified(spark, named) == want
    assert shared_dir(spark) == shared_dir(spark) and "://" in shared_dir(spark)


@pytest.mark.parametrize("uri,path", [("file:///a/b", "/a/b"), ("file:/a/b", "/a/b")])
def test_files_by_uri(uri, path):
    assert opened(uri)[1] == path


def test_batches_are_bounded_and_the_session_is_left_alone(spark):
    confs = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(x) for x in confs]
    df = spark.range(0, 30, 1, 1).select(F.expr("repeat('x', 1000000)").alias("text"))

    def sizes(batches):
        for b in batches:
            assert 0 < b.num_rows <= 2000 and b.nbytes < 20 << 20
            yield b

    assert arrow_map(df, sizes, "text string").count() == 30
    small = spark.range(0, 5000, 1, 1).select(F.col("id").cast("string").alias("text"))
    assert arrow_map(small, sizes, "text string").count() == 5000
    assert before == [spark.conf.get(x) for x in confs]


def test_shards_follow_the_bytes_and_ids_that_repeat_are_dealt_out(spark):
    df = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    dealt = in_order(df, None, shard_bytes=4000)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and sum(sizes) == 4000 and max(sizes) < 2000
