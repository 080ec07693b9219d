import datetime as dt
import uuid
from decimal import Decimal

import pytest

from tessera import Bits, Interval, Union
from tessera import types as t
from tessera.functions.values import checker, reader

U = t.UNION(a=t.I32, b=t.VARCHAR)
GOOD = [
    (t.BOOL, True), (t.I8, -128), (t.U64, 2**64 - 1), (t.HUGEINT, -(2**127)), (t.UHUGEINT, 2**128 - 1), (t.F64, float("inf")), (t.VARCHAR, ""), (t.BLOB, b"\x00"), (t.DATE, dt.date(2020, 2, 29)),
    (t.TIME, dt.time(1, 2, 3, 4)), (t.TIMESTAMP, dt.datetime(2020, 1, 1)), (t.UUID, uuid.UUID(int=7)), (t.INTERVAL, Interval(1, -2, 3)), (t.BIT, Bits.of("101010101")), (t.DECIMAL(4, 2), Decimal("99.99")),
    (t.ENUM("x", "y"), "y"), (t.I32[2], [1, None]), (t.MAP(t.VARCHAR, t.I32), {"a": None}), (t.STRUCT(a=t.I32, b=t.UUID), {"a": 1, "b": uuid.UUID(int=1)}), (U, Union("a", None)), (U, Union("b", "x")), (t.LIST(U), []),
]
BAD = [
    (t.BOOL, 1), (t.I8, 128), (t.U8, -1), (t.I32, 1.0), (t.I32, True), (t.I32, "1"), (t.I32, float("nan")), (t.U64, 2**64), (t.UHUGEINT, 2**128), (t.F64, "1"), (t.VARCHAR, 1), (t.BLOB, "x"), (t.DATE, dt.datetime(2020, 1, 1)),
    (t.TIME, 5), (t.UUID, "123"), (t.INTERVAL, (1, 2, 3)), (t.INTERVAL, Interval(2**31, 0, 0)), (t.BIT, ""), (t.BIT, "012"), (t.DECIMAL(4, 2), Decimal("1.239")), (t.DECIMAL(4, 2), Decimal("100")), (t.DECIMAL(4, 2), 1.5),
    (t.DECIMAL(4, 2), Decimal("nan")), (t.ENUM("x", "y"), "z"), (t.I32[2], [1]), (t.MAP(t.I32, t.I32), {None: 1}), (t.STRUCT(a=t.I32, b=t.I32), {"a": 1}), (t.STRUCT(a=t.I32), {"a": 1, "b": 2}), (U, Union("c", 1)), (U, "x"),
    (t.LIST(t.STRUCT(a=t.I8)), [{"a": 300}]),
]


@pytest.mark.parametrize(("kind", "value"), GOOD)
def test_values_come_back(kind, value):
    stored = checker(kind)(value)
    read = reader(kind)
    assert (read(stored) if read else stored) == value
    assert checker(kind)(None) is None and (read is None or read(None) is None)


@pytest.mark.parametrize(("kind", "value"), BAD)
def test_bad_values_are_errors(kind, value):
    with pytest.raises((TypeError, ValueError, OverflowError)):
        checker(kind)(value)


def test_an_interval_with_a_missing_part_is_null():
    assert checker(t.INTERVAL)(Interval(1, None, 3)) is None


def test_bits():
    for text in ("1", "0000000", "10101010", "101010101", "1" * 24):
        assert str(Bits.of(text)) == text
