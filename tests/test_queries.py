import os

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.queries import SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def base(sf_dir):
    found = duckdb.connect()
    found.execute("SET TimeZone='UTC'")
    for x in TABLES:
        found.execute(f"CREATE VIEW {x} AS SELECT * FROM '{sf_dir}/{x}.parquet'")
    return found


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_equal_sql(spark, base, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    found = base.execute(SQL[name])
    names = [x[0] for x in found.description]
    theirs = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in found.fetchall())
    assert sorted(names) == columns and ours == theirs


def test_entry(spark):
    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert os.path.exists(entry.__file__)


@pytest.mark.parametrize("name", ["hugeint", "uhugeint", "list_null"])
def test_identity_of_large_keys(spark, tmp_path, name):
    keys = [0, 1, 4_105_729, 8_211_456, 53_999_999, 1 << 40, (1 << 63) - 1, -1]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    found = entry.queries()[f"type_identity_{name}"](spark, str(tmp_path)).collect()
    valid = sum(k % 7 != 0 for k in keys)
    assert [tuple(x) for x in found] == [(len(keys), valid, valid, 0, 0)]
