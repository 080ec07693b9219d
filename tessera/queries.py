"""Queries over the test tables, one for each thing the engine does, and the SQL that gives the same rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import types as t
from .engine import Engine
from .functions import exact, temporal
from .functions.values import Bits, Interval, Union
from .sources.table import TableStream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def _view(spark: SparkSession, sf_dir: str, name: str) -> None:
    read(spark, sf_dir, name).createOrReplaceTempView(name)


# -- scalar functions


@query("SELECT l_returnflag, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY 1")
def flagship_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_scalar("net_price", lambda price, off: pc.multiply(price, pc.subtract(1.0, off)), ["f64", "f64"], "f64", mode="vectorized")
    _view(spark, sf_dir, "lineitem")
    return spark.sql("SELECT l_returnflag, round(sum(net_price(l_extendedprice, l_discount)), 2) AS revenue FROM lineitem GROUP BY 1")


@query("SELECT l_orderkey, l_linenumber, (l_linenumber + 1)::INTEGER AS x FROM lineitem")
def scalar_rowwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_scalar("plus_one", lambda x: x + 1, ["i32"], "i32")
    _view(spark, sf_dir, "lineitem")
    return spark.sql("SELECT l_orderkey, l_linenumber, plus_one(l_linenumber) AS x FROM lineitem")


@query("SELECT l_orderkey, l_linenumber, (l_linenumber + 1)::INTEGER AS x FROM lineitem")
def scalar_pickled_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark, "pickled").register_scalar("plus_one_p", lambda x: x + 1, ["i32"], "i32")
    _view(spark, sf_dir, "lineitem")
    return spark.sql("SELECT l_orderkey, l_linenumber, plus_one_p(l_linenumber) AS x FROM lineitem")


@query("SELECT l_orderkey, l_linenumber, l_quantity * 2 AS x FROM lineitem")
def scalar_vectorized(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    e.register_scalar("double_it", lambda x: pc.multiply(x, 2.0), ["f64"], "f64", mode="vectorized")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", e.call("double_it", "l_quantity").alias("x"))


@query("SELECT n_nationkey, 42 AS x FROM nation")
def scalar_zero_arg(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_scalar("answer", lambda: 42, [], "i32")
    _view(spark, sf_dir, "nation")
    return spark.sql("SELECT n_nationkey, answer() AS x FROM nation")


@query("SELECT o_orderkey, concat('got:', o_orderkey) AS a, concat('got:', o_orderpriority, '/', o_custkey) AS b FROM orders")
def scalar_dynamic_args(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_scalar("show_any", lambda *x: "got:" + "/".join(map(str, x)), returns="varchar")
    _view(spark, sf_dir, "orders")
    return spark.sql("SELECT o_orderkey, show_any(o_orderkey) AS a, show_any(o_orderpriority, o_custkey) AS b FROM orders")


@query("""SELECT c_custkey, c_acctbal * 2 + CASE WHEN c_mktsegment = 'BUILDING' THEN 100 ELSE 0 END AS score, c_acctbal AS first_part FROM customer""")
def scalar_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    def score(p: dict) -> dict:
        bonus = 100.0 if p["label"] == "BUILDING" else 0.0
        return {"score": p["x"] * 2 + bonus, "parts": [p["x"], bonus]}

    Engine(spark).register_scalar("score_of", score, [t.STRUCT(x=t.F64, label=t.VARCHAR)], t.STRUCT(score=t.F64, parts=t.F64[:]))
    _view(spark, sf_dir, "customer")
    return spark.sql("WITH s AS (SELECT c_custkey, score_of(named_struct('x', c_acctbal, 'label', c_mktsegment)) AS r FROM customer) SELECT c_custkey, r.score AS score, r.parts[0] AS first_part FROM s")


_NULLED = "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END"


@query(f"SELECT o_orderkey, {_NULLED} + 1 AS x FROM orders")
def null_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_scalar("next_default", lambda x: x + 1, ["i64"], "i64")
    _view(spark, sf_dir, "orders")
    return spark.sql(f"SELECT o_orderkey, next_default({_NULLED}) AS x FROM orders")


@query(f"SELECT o_orderkey, coalesce({_NULLED}, 5) AS x FROM orders")
def null_special(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_scalar("or_five", lambda x: 5 if x is None else x, ["i64"], "i64", null_handling="special")
    _view(spark, sf_dir, "orders")
    return spark.sql(f"SELECT o_orderkey, or_five({_NULLED}) AS x FROM orders")


@query(f"SELECT o_orderkey, {_NULLED} * 2 AS x FROM orders")
def null_vectorized(spark: SparkSession, sf_dir: str) -> DataFrame:
    def twice(x: pa.Array) -> pa.Array:
        if x.null_count:
            raise AssertionError("a NULL got through")
        return pc.multiply(x, 2)

    Engine(spark).register_scalar("twice_valid", twice, ["i64"], "i64", mode="vectorized")
    _view(spark, sf_dir, "orders")
    return spark.sql(f"SELECT o_orderkey, twice_valid({_NULLED}) AS x FROM orders")


@query("SELECT o_orderkey, CASE WHEN o_custkey % 2 = 1 THEN NULL ELSE o_custkey END AS x FROM orders")
def error_return_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    def even(x: int) -> int:
        if x % 2:
            raise ValueError("odd")
        return x

    Engine(spark).register_scalar("even_only", even, ["i64"], "i64", exception_handling="return_null")
    _view(spark, sf_dir, "orders")
    return spark.sql("SELECT o_orderkey, even_only(o_custkey) AS x FROM orders")


@query("SELECT o_orderkey FROM orders WHERE o_custkey > 100")
def side_effect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_scalar("same_volatile", lambda x: x, ["i64"], "i64", side_effects=True)
    _view(spark, sf_dir, "orders")
    return spark.sql("SELECT o_orderkey FROM orders WHERE same_volatile(o_custkey) > 100")


# -- functions within relational operators


def _same(spark: SparkSession, name: str, kind: str) -> Engine:
    e = Engine(spark)
    e.register_scalar(name, lambda x: x, [kind], kind)
    return e


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity * 2 > 90")
def udf_in_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_scalar("double_w", lambda x: pc.multiply(x, 2.0), ["f64"], "f64", mode="vectorized")
    _view(spark, sf_dir, "lineitem")
    return spark.sql("SELECT l_orderkey, l_linenumber FROM lineitem WHERE double_w(l_quantity) > 90")


@query("SELECT l_orderkey, l_linenumber, (l_linenumber + 2)::INTEGER AS x FROM lineitem")
def udf_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_scalar("inc", lambda x: x + 1, ["i32"], "i32")
    _view(spark, sf_dir, "lineitem")
    return spark.sql("SELECT l_orderkey, l_linenumber, inc(inc(l_linenumber)) AS x FROM lineitem")


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def udf_join_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _same(spark, "same_key", "i64")
    orders, customer = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey"), read(spark, sf_dir, "customer", "c_custkey", "c_name")
    return orders.join(customer, e.call("same_key", "o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY -o_orderkey) AS n FROM orders")
def udf_in_window_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_scalar("minus", lambda x: pc.negate(x), ["i64"], "i64", mode="vectorized")
    _view(spark, sf_dir, "orders")
    return spark.sql("SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY minus(o_orderkey)) AS BIGINT) AS n FROM orders")


@query("SELECT lower(o_orderpriority) AS p, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 10")
def udf_in_group_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_scalar("lower_py", lambda x: pc.utf8_lower(x), ["varchar"], "varchar", mode="vectorized")
    _view(spark, sf_dir, "orders")
    return spark.sql("SELECT lower_py(o_orderpriority) AS p, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 10")


@query("SELECT upper(r_name) AS x FROM region UNION ALL SELECT upper(n_name) FROM nation")
def udf_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_scalar("upper_py", lambda x: x.upper(), ["varchar"], "varchar")
    _view(spark, sf_dir, "region")
    _view(spark, sf_dir, "nation")
    return spark.sql("SELECT upper_py(r_name) AS x FROM region UNION ALL SELECT upper_py(n_name) FROM nation")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def udf_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    _same(spark, "same_semi", "i64")
    _view(spark, sf_dir, "orders")
    _view(spark, sf_dir, "customer")
    return spark.sql("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT same_semi(o_custkey) FROM orders WHERE o_orderstatus = 'F')")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY -o_totalprice, o_orderkey LIMIT 25")
def udf_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_scalar("negated", lambda x: pc.negate(x), ["f64"], "f64", mode="vectorized")
    _view(spark, sf_dir, "orders")
    return spark.sql("SELECT o_orderkey, o_totalprice FROM orders ORDER BY negated(o_totalprice), o_orderkey LIMIT 25")


# -- identity of each type through both plans


def _hour(x: str) -> Column:
    return F.expr(f"cast(date_format({x}, 'HH:mm:ss') as time(6))")


def _from_zero(x: str) -> Column:
    """A key's text without its sign bit, so that what counts up or down from a type's bound by it is in range."""
    return F.col(x).bitwiseAND((1 << 63) - 1).cast("string")


_L, _O, _E = "lineitem", "orders", "events"
#: type: table, key, a column of the type as Spark stores it.
_IDENTITY: dict[str, tuple[t.LType, str, str, Callable[[], Column]]] = {
    "bool": (t.BOOL, _L, "l_orderkey", lambda: F.col("l_quantity") > 25),
    "i8": (t.I8, _L, "l_orderkey", lambda: F.col("l_linenumber").cast("tinyint")),
    "u8": (t.U8, _L, "l_orderkey", lambda: F.col("l_quantity").cast("smallint")),
    "i16": (t.I16, _L, "l_orderkey", lambda: F.col("l_linenumber").cast("smallint")),
    "u16": (t.U16, _L, "l_orderkey", lambda: F.col("l_linenumber")),
    "i32": (t.I32, _L, "l_orderkey", lambda: F.col("l_linenumber")),
    "u32": (t.U32, _L, "l_orderkey", lambda: F.col("l_partkey")),
    "i64": (t.I64, _L, "l_orderkey", lambda: F.col("l_orderkey")),
    "u64": (t.U64, _L, "l_orderkey", lambda: F.col("l_orderkey").cast("decimal(20,0)")),
    "f32": (t.F32, _L, "l_orderkey", lambda: F.col("l_discount").cast("float")),
    "f64": (t.F64, _L, "l_orderkey", lambda: F.col("l_extendedprice")),
    "varchar": (t.VARCHAR, _O, "o_orderkey", lambda: F.col("o_orderpriority")),
    "blob": (t.BLOB, _O, "o_orderkey", lambda: F.encode("o_orderpriority", "utf-8")),
    "geometry": (t.GEOMETRY, _O, "o_orderkey", lambda: F.unhex(F.lpad(F.hex("o_orderkey"), 42, "0"))),
    "date": (t.DATE, _O, "o_orderkey", lambda: F.to_date("o_orderdate")),
    "time": (t.TIME, _E, "event_id", lambda: _hour("ts")),
    "timestamp": (t.TIMESTAMP, _L, "l_orderkey", lambda: F.col("l_shipdate").cast("timestamp_ntz")),
    "hugeint": (t.HUGEINT, _O, "o_orderkey", lambda: exact.add(F.lit(str(-(1 << 127))), _from_zero("o_orderkey"), t.HUGEINT)),
    "uhugeint": (t.UHUGEINT, _O, "o_orderkey", lambda: exact.subtract(F.lit(str((1 << 128) - 1)), _from_zero("o_orderkey"), t.UHUGEINT)),
    "uuid": (t.UUID, _O, "o_orderkey", lambda: F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.lower(F.hex("o_orderkey")), 12, "0"))),
    "interval": (t.INTERVAL, _O, "o_orderkey", lambda: exact.interval(F.col("o_orderkey") % 100, F.col("o_custkey") % 30, F.col("o_orderkey") * 1000)),
    "bit": (t.BIT, _O, "o_orderkey", lambda: exact.bits(F.conv(F.col("o_orderkey").cast("string"), 10, 2))),
    "variant": (t.VARIANT, _E, "event_id", lambda: F.parse_json("props")),
    "decimal": (t.DECIMAL(15, 4), _L, "l_orderkey", lambda: F.col("l_discount").cast("decimal(15,4)")),
    "enum": (t.ENUM("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"), _O, "o_orderkey", lambda: F.col("o_orderpriority")),
    "list": (t.F32[:], "embeddings", "vec_id", lambda: F.col("embedding").cast("array<float>")),
    "list_null": (t.LIST(t.I32), _O, "o_orderkey", lambda: F.array((F.col("o_orderkey") % (1 << 31)).cast("int"), F.lit(None), F.lit(3))),
    "list_bigint": (t.LIST(t.I64), _O, "o_orderkey", lambda: F.array("o_orderkey", "o_custkey")),
    "array": (t.F64[3], _L, "l_orderkey", lambda: F.array("l_quantity", "l_discount", "l_tax")),
    "list_of_list": (t.I64[:][:], _O, "o_orderkey", lambda: F.array(F.array("o_orderkey"), F.array("o_custkey", F.lit(None)))),
    "struct": (t.STRUCT(a=t.I64, b=t.VARCHAR), _O, "o_orderkey", lambda: F.struct(F.col("o_custkey").alias("a"), F.col("o_orderpriority").alias("b"))),
    "struct_of_list": (t.STRUCT(id=t.I64, tags=t.VARCHAR[:]), _O, "o_orderkey", lambda: F.struct(F.col("o_custkey").alias("id"), F.array("o_orderpriority", "o_orderstatus").alias("tags"))),
    "array_of_struct": (t.STRUCT(x=t.I64)[2], _O, "o_orderkey", lambda: F.array(F.struct(F.col("o_custkey").alias("x")), F.struct(F.col("o_orderkey").alias("x")))),
    "map": (t.MAP(t.VARCHAR, t.I64), _O, "o_orderkey", lambda: F.create_map("o_orderpriority", "o_custkey")),
    "map_of_struct": (t.MAP(t.I64, t.STRUCT(a=t.VARCHAR)), _O, "o_orderkey", lambda: F.create_map("o_orderkey", F.struct(F.col("o_orderpriority").alias("a")))),
    "union": (
        t.UNION(a=t.I64, b=t.VARCHAR),
        _O,
        "o_orderkey",
        lambda: F.when(F.col("o_orderkey") % 2 == 0, exact.union_value(t.UNION(a=t.I64, b=t.VARCHAR), a=F.col("o_custkey"))).otherwise(exact.union_value(t.UNION(a=t.I64, b=t.VARCHAR), b=F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")))),
    ),
}


def _comparable(x: Column, kind: t.LType) -> Column:
    if kind.name == "variant":
        return F.to_json(x)
    return F.array_sort(F.map_entries(x)) if kind.kind == "map" else x


def _identity(name: str) -> None:
    kind, table, key, make = _IDENTITY[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Every 7th key is NULL; each plan must give back what it got."""
        source = read(spark, sf_dir, table).select(F.col(key).alias("k"), F.when(F.col(key) % 7 != 0, make()).alias("v"))
        for plan in ("arrow", "pickled"):
            made = Engine(spark, plan).register_scalar(f"identity_{name}_{plan}", lambda x: x, [kind], kind)
            source = source.withColumn(plan, made.udf("v"))
        differs = [F.sum(F.when(_comparable(F.col(p), kind).eqNullSafe(_comparable(F.col("v"), kind)), 0).otherwise(1)).alias(f"{p}_differs") for p in ("arrow", "pickled")]
        return source.agg(F.count("*").alias("n"), F.count("arrow").alias("n_arrow"), F.count("pickled").alias("n_pickled"), *differs)

    valid = f"count(*) FILTER ({key} % 7 <> 0)"
    QUERIES[f"type_identity_{name}"] = run
    SQL[f"type_identity_{name}"] = f"SELECT count(*) AS n, {valid} AS n_arrow, {valid} AS n_pickled, 0::BIGINT AS arrow_differs, 0::BIGINT AS pickled_differs FROM {table}"


for _name in _IDENTITY:
    _identity(_name)


# -- exact values


@query("SELECT l_orderkey, l_linenumber, (l_discount::DECIMAL(4,2) + l_tax::DECIMAL(4,2))::DECIMAL(5,2)::VARCHAR AS a, (l_discount::DECIMAL(4,2) - l_tax::DECIMAL(4,2))::DECIMAL(5,2)::VARCHAR AS b FROM lineitem")
def decimal_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("l_discount").cast("decimal(4,2)"), F.col("l_tax").cast("decimal(4,2)")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", exact.decimal_add(x, y, (4, 4), 2).cast("string").alias("a"), exact.decimal_add(x, y, (4, 4), 2, -1).cast("string").alias("b"))


@query("SELECT o_orderkey, (170141183460469231731687303715000000000::HUGEINT + o_orderkey)::VARCHAR AS a, (-o_custkey::HUGEINT - 99999999999999999999)::VARCHAR AS b FROM orders")
def hugeint_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    return read(spark, sf_dir, "orders").select("o_orderkey", exact.add(F.lit("170141183460469231731687303715000000000"), key, t.HUGEINT).alias("a"), exact.subtract(exact.negate(cust, t.HUGEINT), F.lit("9" * 20), t.HUGEINT).alias("b"))


@query("""SELECT o_orderkey, (lpad(bin(o_orderkey), 24, '0')::BIT & lpad(bin(o_custkey), 24, '0')::BIT)::VARCHAR AS a, (lpad(bin(o_orderkey), 24, '0')::BIT | lpad(bin(o_custkey), 24, '0')::BIT)::VARCHAR AS o,
  xor(lpad(bin(o_orderkey), 24, '0')::BIT, lpad(bin(o_custkey), 24, '0')::BIT)::VARCHAR AS x, (~(lpad(bin(o_orderkey), 24, '0')::BIT))::VARCHAR AS n FROM orders""")
def bit_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (exact.bits(F.lpad(F.bin(x), 24, "0")) for x in ("o_orderkey", "o_custkey"))
    return read(spark, sf_dir, "orders").select("o_orderkey", *(exact.bits_text(x).alias(n) for n, x in (("a", exact.bits_and(a, b)), ("o", exact.bits_or(a, b)), ("x", exact.bits_xor(a, b)), ("n", exact.bits_not(a)))))


@query("SELECT o_orderkey, (o_orderkey % 100 + 1)::INTEGER AS months, (o_custkey % 30 - 2)::INTEGER AS days, o_orderkey * 1000 + 3 AS micros FROM orders")
def interval_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = exact.interval(F.col("o_orderkey") % 100, F.col("o_custkey") % 30, F.col("o_orderkey") * 1000)
    df = read(spark, sf_dir, "orders").select("o_orderkey", exact.interval_add(a, exact.interval(F.lit(1), F.lit(-2), F.lit(3))).alias("i"))
    return df.select("o_orderkey", "i.*")


@query("SELECT event_id, hour(ts) * 3600000000 + minute(ts) * 60000000 AS micros, epoch_us(ts) - epoch_us(date_trunc('day', ts)) AS since FROM events")
def temporal_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark)  # makes TIME usable
    ts = F.col("ts").cast("timestamp_ntz")
    midnight = F.date_trunc("day", ts)
    return read(spark, sf_dir, "events").select("event_id", temporal.time_micros(temporal.as_time(F.date_format("ts", "HH:mm"))).alias("micros"), temporal.interval_between(midnight, ts)["micros"].alias("since"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'num' ELSE 'txt' END AS tag, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS num, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS txt FROM orders")
def union_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = t.UNION(num=t.I64, txt=t.VARCHAR)
    made = Engine(spark).register_scalar("choose", lambda k, n, s: Union("num", n) if k % 2 == 0 else Union("txt", s), ["i64", "i64", "varchar"], kind)
    df = read(spark, sf_dir, "orders").select("o_orderkey", made.udf("o_orderkey", "o_custkey", "o_orderpriority").alias("u"))
    return df.select("o_orderkey", exact.union_tag(F.col("u")).alias("tag"), exact.union_extract(F.col("u"), "num").alias("num"), exact.union_extract(F.col("u"), "txt").alias("txt"))


@query("SELECT o_orderkey, list_position(['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH', '1-URGENT'], o_orderpriority)::INTEGER - 1 AS i FROM orders")
def enum_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = t.ENUM("5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT")
    return read(spark, sf_dir, "orders").select("o_orderkey", exact.enum_index(F.col("o_orderpriority"), kind).alias("i"))


@query("SELECT o_orderkey, (o_orderkey % 12)::INTEGER AS months, bin(o_orderkey) AS b FROM orders")
def value_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    make = e.register_scalar("make_interval_py", lambda k: Interval(k % 12, 0, k), ["i64"], "interval")
    bits = e.register_scalar("make_bits_py", lambda k: Bits.of(f"{k:b}"), ["i64"], "bit")
    df = read(spark, sf_dir, "orders").select("o_orderkey", make.udf("o_orderkey")["months"].alias("months"), bits.udf("o_orderkey").alias("bits"))
    return df.select("o_orderkey", "months", exact.bits_text(F.col("bits")).alias("b"))


# -- aggregates


def _sum(e: Engine, name: str, **more: Callable) -> None:
    e.register_aggregate(name, ["i64"], "i64", update=lambda s, x: (s or 0) + x, finalize=lambda s: s, **more)


def _add(a: int, b: int) -> int:
    return a + b


@query("SELECT l_returnflag, sum(l_linenumber)::BIGINT AS total, count(*) AS n FROM lineitem GROUP BY 1")
def agg_sum_rowwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    _sum(e, "sum_row", combine=_add)
    lines = read(spark, sf_dir, "lineitem")
    counted = lines.groupBy(F.col("l_returnflag").alias("flag")).agg(F.count("*").alias("n"))
    return e.aggregate(lines, ["l_returnflag"], "sum_row", "l_linenumber", alias="total").join(counted, F.col("l_returnflag").eqNullSafe(F.col("flag"))).drop("flag")


@query("SELECT l_orderkey, sum(l_linenumber)::BIGINT AS total FROM lineitem GROUP BY 1")
def agg_sql_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In SQL a group is in a row, so groups are small and may be many: the lines of an order."""
    _sum(Engine(spark), "sum_sql")
    _view(spark, sf_dir, "lineitem")
    return spark.sql("SELECT l_orderkey, sum_sql_rows(collect_list(CAST(l_linenumber AS BIGINT))) AS total FROM lineitem GROUP BY 1")


@query("SELECT l_suppkey, sum(l_linenumber)::BIGINT AS total FROM lineitem GROUP BY 1")
def agg_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    def update(states: list, groups: list[int], xs: list[int]) -> list:
        for g, x in zip(groups, xs):
            if g:
                states[g - 1] = (states[g - 1] or 0) + x
        return states

    e = Engine(spark)
    e.register_aggregate("sum_chunk", ["i64"], "i64", update_chunk=update, finalize_chunk=lambda s: s, combine_chunk=lambda a, b: [x + y for x, y in zip(a, b)])
    return e.aggregate(read(spark, sf_dir, "lineitem"), ["l_suppkey"], "sum_chunk", "l_linenumber", alias="total")


@query("SELECT l_returnflag, l_linestatus, sum(l_orderkey)::BIGINT AS total FROM lineitem GROUP BY 1, 2")
def agg_combine_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    _sum(e, "sum_partial", combine=_add)
    return e.aggregate(read(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "sum_partial", "l_orderkey", alias="total")


@query("SELECT l_returnflag, sum(l_linenumber) FILTER (l_quantity > 25)::BIGINT AS total FROM lineitem GROUP BY 1")
def agg_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    _sum(e, "sum_where", combine=_add)
    return e.aggregate(read(spark, sf_dir, "lineitem"), ["l_returnflag"], "sum_where", "l_linenumber", alias="total", where=F.col("l_quantity") > 25)


@query("SELECT l_returnflag, sum(DISTINCT l_linenumber)::BIGINT AS total FROM lineitem GROUP BY 1")
def agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    _sum(e, "sum_distinct", combine=_add)
    return e.aggregate(read(spark, sf_dir, "lineitem"), ["l_returnflag"], "sum_distinct", "l_linenumber", alias="total", distinct=True)


@query("SELECT o_orderstatus, sum(DISTINCT o_custkey)::BIGINT AS total FROM (SELECT * FROM orders WHERE o_custkey < 50) GROUP BY 1")
def agg_distinct_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a Column, for groups that fit in a row."""
    e = Engine(spark)
    _sum(e, "sum_distinct_column")
    return read(spark, sf_dir, "orders").where("o_custkey < 50").groupBy("o_orderstatus").agg(e.agg("sum_distinct_column", "o_custkey", distinct=True).alias("total"))


@query("SELECT CASE WHEN l_linenumber % 3 = 0 THEN 'NaN' ELSE '0' END AS k, sum(l_orderkey)::BIGINT AS total FROM lineitem GROUP BY 1")
def agg_nan_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    _sum(e, "sum_nan_key", combine=_add)
    number = F.col("l_linenumber")
    keyed = read(spark, sf_dir, "lineitem").withColumn("x", F.when(number % 3 == 0, float("nan")).when(number % 3 == 1, -0.0).otherwise(0.0))
    found = e.aggregate(keyed, ["x"], "sum_nan_key", "l_orderkey", alias="total")
    return found.select(F.when(F.isnan("x"), "NaN").otherwise(F.col("x").cast("int").cast("string")).alias("k"), "total")


@query("SELECT l_returnflag AS a, l_linestatus AS b, sum(l_orderkey)::BIGINT AS total FROM lineitem GROUP BY 1, 2")
def agg_nested_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    _sum(e, "sum_nested_key", combine=_add)
    keyed = read(spark, sf_dir, "lineitem").select("l_orderkey", F.array("l_returnflag").alias("k"), F.struct("l_linestatus", F.lit(None).cast("double").alias("none")).alias("s"))
    found = e.aggregate(keyed, ["k", "s"], "sum_nested_key", "l_orderkey", alias="total")
    return found.select(F.col("k")[0].alias("a"), F.col("s.l_linestatus").alias("b"), "total")


@query("SELECT sum(l_orderkey)::BIGINT AS total FROM lineitem")
def agg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    _sum(e, "sum_global", combine=_add)
    return e.aggregate(read(spark, sf_dir, "lineitem"), [], "sum_global", "l_orderkey", alias="total")


@query("SELECT l_returnflag, l_linestatus, sum(l_linenumber)::BIGINT AS total FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def agg_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    _sum(e, "sum_rollup", combine=_add)
    return e.aggregate(read(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "sum_rollup", "l_linenumber", alias="total", sets=[["l_returnflag", "l_linestatus"], ["l_returnflag"], []])


@query("SELECT l_returnflag, l_linestatus, sum(l_linenumber)::BIGINT AS total FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def agg_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    _sum(e, "sum_cube", combine=_add)
    return e.aggregate(read(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "sum_cube", "l_linenumber", alias="total", sets=[["l_returnflag", "l_linestatus"], ["l_returnflag"], ["l_linestatus"], []])


@query("SELECT l_orderkey, l_linenumber, sum(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)::BIGINT AS total FROM lineitem")
def agg_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    _sum(e, "sum_window")
    lines = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    return e.window(lines, "sum_window", "l_linenumber", partition=["l_orderkey"], order=["l_linenumber"], rows=(-1, 0), alias="total")


@query("SELECT coalesce(sum(l_linenumber), -1)::BIGINT AS total FROM lineitem WHERE l_quantity < 0")
def agg_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    e.register_aggregate("sum_or_none", ["i64"], "i64", update=lambda s, x: (s or 0) + x, finalize=lambda s: -1 if s is None else s, combine=_add)
    none = read(spark, sf_dir, "lineitem").where("l_quantity < 0")
    return e.aggregate(none, [], "sum_or_none", "l_linenumber", alias="total")


@query(f"SELECT o_orderstatus, sum(CASE WHEN ({_NULLED}) IS NULL THEN 1 ELSE 0 END)::BIGINT AS missing FROM orders GROUP BY 1")
def agg_null_special(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    e.register_aggregate("count_missing", ["i64"], "i64", null_handling="special", update=lambda s, x: (s or 0) + (x is None), finalize=lambda s: s or 0, combine=_add)
    return e.aggregate(read(spark, sf_dir, "orders").withColumn("x", F.expr(_NULLED)), ["o_orderstatus"], "count_missing", "x", alias="missing")


@query("""SELECT o_custkey, o_orderpriority AS most FROM (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS k FROM orders GROUP BY 1, 2) WHERE k = 1""")
def agg_object_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    def update(s: Counter | None, x: str) -> Counter:
        s = Counter() if s is None else s
        s[x] += 1
        return s

    e = Engine(spark)
    e.register_aggregate("most_frequent", ["varchar"], "varchar", update=update, combine=lambda a, b: a + b, copy=Counter, finalize=lambda s: min(s, key=lambda x: (-s[x], x)) if s else None)
    return e.aggregate(read(spark, sf_dir, "orders"), ["o_custkey"], "most_frequent", "o_orderpriority", alias="most")


# -- table functions and results in batches


def _numbers(n: int) -> dict:
    return {"i": list(range(1, n + 1)), "x": [k * 1.5 for k in range(1, n + 1)], "s": [f"v{k}" for k in range(1, n + 1)]}


@query("SELECT i, (i * 1.5)::DOUBLE AS x, concat('v', i) AS s FROM range(1, 101) AS r(i)")
def table_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_table("numbers", _numbers, chunk_size=2)
    return spark.sql("SELECT i, x, s FROM numbers(100)")


@query("SELECT i, concat('v', i) AS s FROM range(1, 4) AS r(i)")
def table_args(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_table("numbers_args", _numbers)
    return spark.sql("SELECT i, s FROM numbers_args(1 + 2)")


def _counted(n: int, step: int = 7) -> TableStream:
    at = 0

    def pull(k: int) -> dict | None:
        nonlocal at
        if at >= n:
            return None
        low, at = at, min(n, at + step)
        return {"i": list(range(low + 1, at + 1))}

    return TableStream({"i": [0]}, pull, cardinality=n, exact=True)


@query("SELECT i FROM range(1, 1001) AS r(i)")
def table_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    e.register_table("counted", lambda n: _counted(n), chunk_size=2)
    return e.table("counted", 1000)


@query("SELECT i FROM range(1, 51) AS r(i)")
def table_stream_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_table("counted_sql", lambda n: _counted(n), chunk_size=4)
    return spark.sql("SELECT i FROM counted_sql(50)")


@query("SELECT i AS part, count(*) AS n FROM range(0, 8) AS p(i), range(0, 100) GROUP BY 1")
def table_stream_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def made(per: int) -> TableStream:
        def begin(part: int, parts: int) -> tuple:
            left = [{"part": [part] * per}]
            return (lambda: left.pop() if left else None), None

        return TableStream({"part": [0]}, open=begin, parts=8)

    e = Engine(spark)
    e.register_table("parted", made)
    return e.table("parted", 100).groupBy("part").agg(F.count("*").alias("n"))


@query("SELECT n_name, i FROM nation, range(1, 4) AS r(i) WHERE n_regionkey = 1")
def table_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    Engine(spark).register_table("few", lambda n: {"i": list(range(1, n + 1))})
    _view(spark, sf_dir, "nation")
    return spark.sql("SELECT n_name, i FROM nation, few(3) WHERE n_regionkey = 1")


@query("SELECT count(*) AS n, sum(s_suppkey)::BIGINT AS keys, sum(length(s_name))::BIGINT AS letters, least(count(*), 64) AS most, ceil(count(*) / 64)::BIGINT AS batches FROM supplier")
def query_stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What passes through the driver, a batch at a time, is counted there and not kept."""
    n = keys = letters = most = batches = 0
    with Engine(spark).query_stream(read(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_acctbal"), batch_rows=64) as stream:
        for batch in stream:
            n, most, batches = n + batch.num_rows, max(most, batch.num_rows), batches + 1
            keys += pc.sum(batch["s_suppkey"]).as_py()
            letters += pc.sum(pc.utf8_length(batch["s_name"])).as_py()
    return spark.createDataFrame([(n, keys, letters, most, batches)], "n long, keys long, letters long, most long, batches long")


@query("SELECT o_orderkey, round(o_totalprice * CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END, 2) AS score FROM orders WHERE o_totalprice * CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END > 1000")
def bridge_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Engine(spark).bind({"local_score": t.F64}, local_score=lambda x, label: x * (2 if label == "1-URGENT" else 1)) as b:
        scored = read(spark, sf_dir, "orders").withColumn("score", b.local_score("o_totalprice", "o_orderpriority"))
        return scored.where("score > 1000").select("o_orderkey", F.round("score", 2).alias("score")).orderBy("o_orderkey")


@query("SELECT 0::BIGINT AS reference, 0::BIGINT AS pickled, 0::BIGINT AS arrow")
def plans_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Engine(spark).self_test(1000)
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{x} long" for x in found))


@query("SELECT event_type, date_trunc('hour', ts) AS start, count(*) AS n, round(sum(value * 2), 2) AS total FROM events GROUP BY 1, 2")
def windowed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .streaming.results import windowed_counts

    e = Engine(spark)
    e.register_scalar("double_value", lambda x: pc.multiply(x, 2.0), ["f64"], "f64", mode="vectorized")
    events = read(spark, sf_dir, "events").withColumn("value", e.call("double_value", "value")).withColumn("ts", F.col("ts").cast("timestamp"))
    found = windowed_counts(events, "ts", "event_type", "value")
    return found.select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), "n", F.round("total", 2).alias("total"))


@query("SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY 1")
def date_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Engine(spark)
    made = e.register_scalar("day_of", lambda x: dt.date(x.year, x.month, x.day), ["timestamp"], "date")
    return read(spark, sf_dir, "orders").groupBy(made.udf(F.col("o_orderdate").cast("timestamp_ntz")).alias("d")).agg(F.count("*").alias("n"))


# -- types of arguments in SQL, results and streams


@query("SELECT l_orderkey, l_linenumber, (l_linenumber * 2)::BIGINT AS x, l_quantity / 2 AS y, 0 AS refused FROM lineitem")
def scalar_sql_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL casts an INTEGER to the declared BIGINT; text for a number is refused under each plan."""
    found, refused = None, 0
    for plan in ("pickled", "arrow"):
        e = Engine(spark, plan)
        e.register_scalar("sql_twice", lambda x: x * 2, ["i64"], "i64")
        e.register_scalar("sql_half", lambda x: x / 2, ["f64"], "f64")
        _view(spark, sf_dir, "lineitem")
        try:
            spark.sql("SELECT sql_twice('2')").collect()
            refused += 1
        except Exception as error:
            if "TypeError" not in str(error):
                raise
        mine = spark.sql("SELECT l_orderkey, l_linenumber, sql_twice(l_linenumber) AS x, sql_half(l_quantity) AS y FROM lineitem")
        found = mine.where("l_linenumber > 2") if found is None else found.unionByName(mine.where("l_linenumber <= 2"))
    return found.withColumn("refused", F.lit(refused))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey * 2 END AS x FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 5 = 0")
def error_return_null_vectorized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch fails as a whole; here the rows that fail are batches of their own."""
    from .plans.plan import Plan

    def twice(x: pa.Array) -> pa.Array:
        if pc.any(pc.equal(pc.subtract(x, pc.multiply(pc.divide(x, 5), 5)), 0)).as_py():
            raise ValueError("not these")
        return pc.multiply(x, 2)

    e = Engine(spark, Plan("arrow"))
    e.register_scalar("twice_or_null", twice, ["i64"], "i64", mode="vectorized", exception_handling="return_null")
    orders = read(spark, sf_dir, "orders", "o_orderkey")
    good, bad = orders.where("o_orderkey % 5 <> 0"), orders.where("o_orderkey % 5 = 0")
    return good.unionByName(bad).select("o_orderkey", e.call("twice_or_null", "o_orderkey").alias("x"))


@query("SELECT l_orderkey, l_linenumber, l_partkey AS a, 'p' || l_partkey AS b FROM lineitem")
def vectorized_struct_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with the fields' names is a column of structs."""
    e = Engine(spark)
    e.register_scalar("as_fields", lambda x: pa.table({"a": x, "b": pc.binary_join_element_wise("p", x.cast(pa.string()), "")}), ["i64"], t.STRUCT(a=t.I64, b=t.VARCHAR), mode="vectorized")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", e.call("as_fields", "l_partkey").alias("s")).select("l_orderkey", "l_linenumber", "s.*")


@query("SELECT 4::BIGINT AS refused")
def results_are_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrong results are errors, whatever the error policy: a fraction or text for a whole number, one out of range, a column of another length."""
    e, refused = Engine(spark), 0
    cases = [(lambda x: 1.5, "i64", "scalar"), (lambda x: "a", "i64", "scalar"), (lambda x: 300, "u8", "scalar"), (lambda x: pa.array([1]), "i64", "vectorized")]
    keys = read(spark, sf_dir, "nation", "n_nationkey")
    for i, (fun, kind, mode) in enumerate(cases):
        e.register_scalar(f"wrong_{i}", fun, ["i64"], kind, mode=mode, exception_handling="return_null")
        try:
            keys.select(e.call(f"wrong_{i}", "n_nationkey")).collect()
        except Exception as error:
            if not any(x in str(error) for x in ("TypeError", "OverflowError", "ValueError", "ArrowInvalid")):
                raise
            refused += 1
    return spark.createDataFrame([(refused,)], "refused long")


@query("SELECT 64::BIGINT AS pulled, 1::BIGINT AS ended")
def query_stream_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream closed early gives no more."""
    with Engine(spark).query_stream(read(spark, sf_dir, "lineitem", "l_orderkey"), batch_rows=64) as stream:
        pulled = stream.next_batch().num_rows
    return spark.createDataFrame([(pulled, int(stream.next_batch() is None))], "pulled long, ended long")
