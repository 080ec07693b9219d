"""Values that Python has no class for, and the strict check of values against a descriptor.

A check gives the value in the form that Spark stores, or raises; it never rounds, wraps, cuts or
fills in. A reader gives user code the value of what Spark stored.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable
from decimal import Decimal
from numbers import Integral, Real
from typing import Any, NamedTuple

from ..types import INTEGERS, LType

_UUID = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}")


class Interval(NamedTuple):
    """Months, days and microseconds, which are never turned into one another."""

    months: int
    days: int
    micros: int


class Bits(NamedTuple):
    """Bits from the highest of the first byte on."""

    data: bytes
    length: int

    @classmethod
    def of(cls, text: str) -> Bits:
        if not text or set(text) - {"0", "1"}:
            raise ValueError("bits are written as 0 and 1, one at least")
        return cls(int(text.ljust(-(-len(text) // 8) * 8, "0"), 2).to_bytes(-(-len(text) // 8), "big"), len(text))

    def __str__(self) -> str:
        return bin(int.from_bytes(b"\x01" + self.data, "big"))[3 : 3 + self.length]


class Union(NamedTuple):
    tag: str
    value: Any


def _fail(x: Any, kind: LType) -> Any:
    raise TypeError(f"{x!r} ({type(x).__name__}) is no {kind.sql}")


def whole(x: Any, kind: LType) -> int:
    if isinstance(x, bool) or not isinstance(x, Integral):
        _fail(x, kind)
    low, high = INTEGERS[kind.name]
    if not low <= x <= high:
        raise OverflowError(f"{x} is out of range for {kind.sql}")
    return int(x)


def decimal(x: Any, width: int, scale: int) -> Decimal:
    """x at that scale; digits that do not fit are an error."""
    if isinstance(x, bool) or not isinstance(x, (int, str, Decimal)):
        raise TypeError(f"{x!r} is no DECIMAL({width}, {scale})")
    value = Decimal(x)
    if not value.is_finite():
        raise TypeError(f"{x!r} is no DECIMAL({width}, {scale})")
    sign, digits, exponent = value.as_tuple()
    kept = int("".join(map(str, digits)) or "0")
    shift = exponent + scale
    if shift < 0:
        kept, rest = divmod(kept, 10**-shift)
        if rest:
            raise ValueError(f"{x} has more than {scale} digits after the point")
    else:
        kept *= 10**shift
    if kept >= 10**width:
        raise OverflowError(f"{x} is too wide for DECIMAL({width}, {scale})")
    return Decimal((sign, tuple(map(int, str(kept))), -scale))


def uuid_text(x: Any) -> str:
    text = str(x).strip().lower() if isinstance(x, (str, uuid.UUID)) else ""
    if not _UUID.fullmatch(text):
        raise ValueError(f"{x!r} is no UUID")
    return text


def _bits(x: Any, kind: LType) -> dict[str, Any]:
    x = Bits.of(x) if isinstance(x, str) else x
    if not isinstance(x, Bits) or x.length < 1 or len(x.data) != -(-x.length // 8):
        _fail(x, kind)
    return {"data": bytes(x.data), "length": x.length}


def _interval(x: Any, kind: LType) -> dict[str, int] | None:
    if not isinstance(x, Interval):
        _fail(x, kind)
    if any(v is None for v in x):
        return None
    for v, n in zip(x, (32, 32, 64)):
        if isinstance(v, bool) or not isinstance(v, Integral) or not -(1 << n - 1) <= v < 1 << n - 1:
            raise OverflowError(f"{x} is out of range for INTERVAL")
    return {k: int(v) for k, v in x._asdict().items()}


def _timestamp(x: Any, kind: LType) -> dt.datetime:
    if not isinstance(x, dt.datetime):
        _fail(x, kind)
    return x.astimezone(dt.UTC).replace(tzinfo=None) if x.tzinfo else x


def _one(kind: LType, *classes: type, make: Callable = lambda x: x) -> Callable[[Any], Any]:
    return lambda x: make(x) if isinstance(x, classes) and not (isinstance(x, bool) and bool not in classes) else _fail(x, kind)


def _scalar(kind: LType) -> Callable[[Any], Any]:
    if kind.name in ("hugeint", "uhugeint"):
        return lambda x: str(whole(x, kind))
    if kind.name == "u64":
        return lambda x: Decimal(whole(x, kind))
    if kind.name in INTEGERS:
        return lambda x: whole(x, kind)
    match kind.name:
        case "bool":
            return lambda x: bool(x) if isinstance(x, bool) or type(x).__name__ in ("bool", "bool_") else _fail(x, kind)
        case "f32" | "f64":
            return _one(kind, Real, make=float)
        case "varchar":
            return _one(kind, str)
        case "blob" | "geometry":
            return _one(kind, bytes, bytearray, memoryview, make=bytes)
        case "date":
            return lambda x: x if isinstance(x, dt.date) and not isinstance(x, dt.datetime) else _fail(x, kind)
        case "time":
            return lambda x: x if isinstance(x, dt.time) and x.tzinfo is None else _fail(x, kind)
        case "timestamp":
            return lambda x: _timestamp(x, kind)
        case "uuid":
            return uuid_text
        case "interval":
            return lambda x: _interval(x, kind)
        case "bit":
            return lambda x: _bits(x, kind)
    from pyspark.sql import VariantVal

    return _one(kind, VariantVal)


def _fields(x: Any, kind: LType) -> dict[str, Any]:
    if hasattr(x, "asDict"):
        x = x.asDict()
    elif hasattr(x, "_asdict"):
        x = x._asdict()
    if not isinstance(x, dict):
        _fail(x, kind)
    if set(x) != set(kind.names):
        raise TypeError(f"{kind.sql} has the fields {', '.join(kind.names)}, not {', '.join(map(str, x))}")
    return x


def checker(kind: LType) -> Callable[[Any], Any]:
    """The check of values of that type, None included."""
    inner = [checker(x) for x in kind.children]

    def items(x: Any) -> list:
        if hasattr(x, "tolist") and not isinstance(x, (bytes, str)):
            x = x.tolist()
        if not isinstance(x, (list, tuple)) or isinstance(x, (Interval, Bits, Union)):
            _fail(x, kind)
        if kind.kind == "array" and len(x) != kind.size:
            raise ValueError(f"{kind.sql} has {kind.size} items, not {len(x)}")
        return [inner[0](v) for v in x]

    def table(x: Any) -> dict:
        if not isinstance(x, dict):
            _fail(x, kind)
        if None in x:
            raise TypeError("a map has no NULL key")
        out = {inner[0](k): inner[1](v) for k, v in x.items()}
        if len(out) < len(x):
            raise ValueError("a map has each key once")
        return out

    def struct(x: Any) -> dict:
        found = _fields(x, kind)
        return {n: check(found[n]) for n, check in zip(kind.names, inner)}

    def union(x: Any) -> dict:
        if not isinstance(x, Union) or x.tag not in kind.names:
            _fail(x, kind)
        return {"tag": x.tag} | {n: check(x.value) if n == x.tag else None for n, check in zip(kind.names, inner)}

    match kind.kind:
        case "scalar":
            own = _scalar(kind)
        case "decimal":
            own = lambda x: decimal(x, *kind.parameters)
        case "enum":
            labels = frozenset(kind.names)
            own = lambda x: x if isinstance(x, str) and x in labels else _fail(x, kind)
        case "list" | "array":
            own = items
        case "map":
            own = table
        case "struct":
            own = struct
        case _:
            own = union
    return lambda x: None if x is None else own(x)


def _get(x: Any, name: str) -> Any:
    return x[name]


def reader(kind: LType) -> Callable[[Any], Any] | None:
    """What user code gets for a stored value, None included; None if that is the stored value itself."""
    inner = [reader(x) for x in kind.children]
    same = lambda f: f or (lambda v: v)
    own: Callable[[Any], Any] | None = None
    match kind.kind, kind.name:
        case "scalar", "hugeint" | "uhugeint" | "u64":
            own = int
        case "scalar", "f32" | "f64":
            own = float
        case "scalar", "uuid":
            own = uuid.UUID
        case "scalar", "interval":
            own = lambda x: Interval(_get(x, "months"), _get(x, "days"), _get(x, "micros"))
        case "scalar", "bit":
            own = lambda x: Bits(bytes(_get(x, "data")), _get(x, "length"))
        case "scalar", "blob" | "geometry":
            own = bytes
        case ("list" | "array"), _:
            if inner[0]:
                own = lambda x: [inner[0](v) for v in x]
        case "map", _:
            own = lambda x: {same(inner[0])(k): same(inner[1])(v) for k, v in (x.items() if isinstance(x, dict) else x)}
        case "struct", _:
            own = lambda x: {n: same(f)(_get(x, n)) for n, f in zip(kind.names, inner)}
        case "union", _:
            own = lambda x: Union(_get(x, "tag"), same(inner[kind.names.index(_get(x, "tag"))])(_get(x, _get(x, "tag"))))
    return own and (lambda x: None if x is None else own(x))
