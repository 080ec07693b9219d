import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tessera import Engine
from tessera import types as t
from tessera.functions import exact, temporal


def ids(spark, n=10):
    return spark.range(n).withColumn("x", F.expr("CASE WHEN id % 3 = 0 THEN NULL ELSE id END"))


@pytest.mark.parametrize("plan", ["arrow", "pickled", "reference"])
def test_null_and_error_policies(spark, plan):
    e, df = Engine(spark, plan), ids(spark)
    calls = lambda fun, **o: [r[0] for r in df.select(e.register_scalar("f", fun, ["i64"], "i64", **o).udf("x")).collect()]
    assert calls(lambda x: x + 1) == [None if i % 3 == 0 else i + 1 for i in range(10)]
    assert calls(lambda x: -1 if x is None else x, null_handling="special") == [-1 if i % 3 == 0 else i for i in range(10)]
    assert calls(lambda x: 1 // (x % 2), exception_handling="return_null") == [1 if i % 3 and i % 2 else None for i in range(10)]
    for bad in (lambda x: 1.5, lambda x: "a", lambda x: 2**63, lambda x: 1 // 0):
        with pytest.raises(Exception, match="TypeError|OverflowError|ZeroDivisionError"):
            calls(bad)
    with pytest.raises(Exception, match="TypeError"):  # results are checked outside the error policy
        calls(lambda x: "a", exception_handling="return_null")


def test_vectorized_rules(spark):
    e, df = Engine(spark), ids(spark).coalesce(1)
    calls = lambda fun, returns="i64", **o: [r[0] for r in df.select(e.register_scalar("v", fun, ["i64"], returns, mode="vectorized", **o).udf("x")).collect()]
    assert calls(lambda x: pc.add(x, 1)) == [None if i % 3 == 0 else i + 1 for i in range(10)]
    assert calls(lambda x: [1] * len(x), "i8") == [None if i % 3 == 0 else 1 for i in range(10)]
    assert calls(lambda x: None) == [None] * 10
    assert calls(lambda x: 1 // 0, exception_handling="return_null") == [None] * 10
    assert calls(lambda x: pa.table({"a": x, "b": x}).to_pandas(), t.STRUCT(a=t.I64, b=t.F64))[1] == (1, 1.0)
    for bad, kind in ((lambda x: [1], "i64"), (lambda x: ["a"] * len(x), "i64"), (lambda x: [1.5] * len(x), "i64"), (lambda x: [300] * len(x), "u8"), (lambda x: [300] * len(x), "i8")):
        with pytest.raises(Exception):  # noqa: B017
            calls(bad, kind, exception_handling="return_null")


def test_registration_is_strict(spark):
    e = Engine(spark)
    for bad in (
        lambda: e.register_scalar("f", abs, ["i64"]), lambda: e.register_scalar("f", abs, [], "i64", mode="vectorized"), lambda: e.register_scalar("f", abs, ["i64"], "i64", mode="rows"),
        lambda: e.register_scalar("f", abs, ["i64"], "i64", null_handling="x"), lambda: e.set_plan("threads"), lambda: e.set_plan("arrow", batch_rows=0), lambda: e.call("nobody", "x"), lambda: e.register_table("r", lambda *a: 1),
        lambda: Engine(spark, "pickled").register_scalar("f", abs, ["i64"], "i64", mode="vectorized"), lambda: e.register_aggregate("a", ["i64"], "i64", finalize=abs), lambda: e.register_aggregate("a", [], "i64", update=max, finalize=abs),
    ):
        with pytest.raises((TypeError, ValueError, NameError)):
            bad()
    e.set_plan("arrow", most_bytes=1000)
    blob = bytes(5000)
    with pytest.raises(ValueError):
        e.register_scalar("f", lambda x: len(blob), ["i64"], "i64")


def test_replacing_explaining_and_counting(spark):
    e = Engine(spark)
    e.register_scalar("g", lambda x: x + 1, ["i64"], "i64")
    assert spark.sql("SELECT g(1L)").first()[0] == 2
    made = e.register_scalar("g", lambda x: x + 2, ["i64"], "i64")
    assert spark.sql("SELECT g(1L)").first()[0] == 3
    e.reset_counters()
    ids(spark).select(made.udf("x")).collect()
    told = e.explain("g")
    assert told["signature"] == "g(BIGINT) -> BIGINT" and told["plan"] == "arrow" and not told["dynamic"]
    assert told["rows"] >= 10 and told["calls"] >= 6 and told["null_skips"] >= 4
    assert "g" in [x["name"] for x in e.list()] and e.stats()["functions"] == 1 and "g(BIGINT)" in repr(made)
    other = spark.newSession()
    e.attach(other)
    assert other.sql("SELECT g(5L)").first()[0] == 7


def test_dynamic_arguments_need_types(spark):
    Engine(spark).register_scalar("any_of", lambda *x: str(x), returns="varchar", null_handling="special")
    assert spark.sql("SELECT any_of(1, 'a', array(1.5D))").first()[0] == "(1, 'a', [1.5])"
    with pytest.raises(Exception, match="concrete"):
        spark.sql("SELECT any_of(NULL)").collect()


def test_bridge(spark):
    e = Engine(spark)
    with e.bind({"twice": t.I64}, twice=lambda x: 2 * x) as b:
        assert [r[0] for r in spark.range(3).select(b.twice("id")).collect()] == [0, 2, 4]
        with pytest.raises(AttributeError):
            b.other("id")
    with pytest.raises(NameError):
        e.bind({"missing": t.I64})
    with pytest.raises(ValueError):
        e.bind({})


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_exact_columns(spark):
    lit = F.lit
    assert one(spark, exact.add(lit(str(2**127 - 2)), lit("1"), t.HUGEINT)) == str(2**127 - 1)
    assert one(spark, exact.subtract(lit("5"), lit(str(10**38)), t.HUGEINT)) == str(5 - 10**38)
    assert one(spark, exact.negate(lit("0"), t.UHUGEINT)) == "0" and one(spark, exact.add(lit(None).cast("string"), lit("1"), t.HUGEINT)) is None
    assert one(spark, exact.integer(lit("255"), t.U8)) == 255 and str(one(spark, exact.decimal(lit("1.230"), 4, 2))) == "1.23"
    assert one(spark, exact.uuid(lit(" ABCDEF00-0000-4000-8000-000000000000 "))) == "abcdef00-0000-4000-8000-000000000000"
    assert tuple(one(spark, temporal.as_interval(lit(1.5), "mins"))) == (0, 0, 90_000_000) and one(spark, exact.interval(lit(1), lit(None), lit(1))) is None
    for bad in (
        exact.add(lit(str(2**127 - 1)), lit("1"), t.HUGEINT), exact.negate(lit("1"), t.UHUGEINT), exact.add(lit(127), lit(1), t.I8), exact.integer(lit("1.5"), t.I32), exact.decimal(lit("1.239"), 4, 2), exact.decimal(lit("1000"), 4, 2),
        exact.uuid(lit("12")), exact.enum(lit("z"), t.ENUM("a", "b")), exact.bits(lit("012")), exact.bits_and(exact.bits(lit("1")), exact.bits(lit("11"))), exact.array_of(F.array(lit(1)), 2),
    ):
        with pytest.raises(Exception):  # noqa: B017
            one(spark, bad)


def test_huge_keys_sort_as_numbers(spark):
    values = [0, -1, 1, 10**38, -(10**38), 2**127 - 1, -(2**127), 99, -99]
    df = spark.createDataFrame([(str(x),) for x in values], "x string")
    assert [int(r[0]) for r in df.orderBy(exact.huge_key(F.col("x"))).collect()] == sorted(values)


def test_tables_of_semantics(spark):
    from tessera import semantics

    assert semantics.argument_types(spark).count() == 23 and semantics.value_rules(spark, ["i8", t.DECIMAL(4, 2)]).count() == 2 and semantics.modes(spark).count() == 2
    assert Engine(spark).capabilities() == {"variant": True, "time": True} and Engine(spark).backend()["parallelism"] > 0


@pytest.mark.parametrize("plan", ["arrow", "pickled"])
def test_sql_arguments_have_the_declared_types(spark, plan):
    e = Engine(spark, plan)
    e.register_scalar("typed_int", lambda x: str(x), ["i64"], "varchar")
    e.register_scalar("typed_small", lambda x: x, ["u8"], "i64")
    e.register_scalar("typed_real", lambda x: x / 2, ["f64"], "f64")
    assert [r[0] for r in spark.sql("SELECT typed_int(x) FROM VALUES (CAST(1 AS TINYINT)), (NULL) AS t(x)").collect()] == ["1", None]
    assert spark.sql("SELECT typed_real(3), typed_small(7), typed_int(NULL)").first() == (1.5, 7, None)
    for bad in ("typed_int('abc')", "typed_int(array(1))", "typed_int(1.5D)", "typed_int(true)", "typed_int(1, 2)", "typed_real('1')", "typed_small(300)", "typed_small(-1)"):
        with pytest.raises(Exception, match="TypeError|OverflowError"):
            spark.sql(f"SELECT {bad}").collect()
