import random

import pytest

from tessera import types as t


def anything(r, depth=0):
    k = r.randrange(8 if depth < 4 else 2)
    inner = lambda: anything(r, depth + 1)
    match k:
        case 0:
            return r.choice(list(t.SCALARS.values()))
        case 1:
            return r.choice([t.DECIMAL(9, 2), t.ENUM("a", "b|c", "d;<e>", "f%"), t.DECIMAL(38, 38)])
        case 2:
            return t.LIST(inner())
        case 3:
            return t.ARRAY(inner(), r.randint(1, 9))
        case 4:
            return t.MAP(t.VARCHAR, inner())
        case 5:
            return t.UNION(a=inner(), b=inner())
    return t.STRUCT(**{n: inner() for n in ("x", "y:z", "a b")[: r.randint(1, 3)]})


def test_tokens_are_read_back():
    r = random.Random(1)
    for _ in range(500):
        kind = anything(r)
        assert t.is_type(kind) and t.parse(kind.token) == kind and kind.spark and kind.sql


def test_texts():
    assert t.STRUCT(a=t.I32[:], b=t.F64[3]).sql == "STRUCT(a INTEGER[], b DOUBLE[3])"
    assert t.signature("f", None, t.VARCHAR) == "f(...) -> VARCHAR" and t.signature("f", [t.I32], t.UUID) == "f(INTEGER) -> UUID"
    assert t.normalize("integer") == t.normalize("i32") == t.I32
    assert t.I32[3].size == 3 and t.I32[:].size is None


@pytest.mark.parametrize("make", [lambda: t.DECIMAL(39, 0), lambda: t.DECIMAL(5, 6), lambda: t.ENUM(), lambda: t.ENUM("a", "a"), lambda: t.ARRAY(t.I32, 0), lambda: t.STRUCT(), lambda: t.UNION(tag=t.I32), lambda: t.normalize("list<i32>"), lambda: t.parse("nothing"), lambda: t.parse("decimal<1>")])
def test_unsound_types_are_errors(make):
    with pytest.raises((ValueError, TypeError)):
        make()


def test_depth():
    kind = t.I32
    for _ in range(t.MAX_DEPTH - 1):
        kind = kind[:]
    with pytest.raises(ValueError):
        kind[:]


def test_spark_types_have_descriptors():
    for kind in (t.I64, t.LIST(t.STRUCT(a=t.F64, b=t.MAP(t.VARCHAR, t.DATE))), t.INTERVAL, t.BIT, t.DECIMAL(9, 3)):
        assert t.from_spark(kind.spark) == kind
