"""Exact arithmetic on columns: integers of 8 to 128 bits, decimals without rounding, intervals, bits, enums and unions.

All of it is Spark expressions; a value out of range raises in the query. NULL in gives NULL out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..types import INTEGERS, LType


def _checked(ok: Column, value: Column, message: Column | str) -> Column:
    """value, but an error where ok is false."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(F.coalesce(~ok, F.lit(False)), F.raise_error(text)).otherwise(value)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed, and written into the plan, once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def integer(x: Column, kind: LType) -> Column:
    """x (any exact number or its text) as the type stores it, if it is whole and in range."""
    low, high = INTEGERS[kind.name]
    if kind.name in ("hugeint", "uhugeint"):
        return _huge_text(*_huge_parts(x.cast("string"), kind), kind)
    wide = x.cast("decimal(38,10)")
    ok = (wide == F.floor(wide)) & wide.between(F.lit(str(low)).cast("decimal(38,0)"), F.lit(str(high)).cast("decimal(38,0)"))
    return _checked(ok, wide.cast("decimal(38,0)").cast(kind.spark), F.concat(x.cast("string"), F.lit(f" is out of range for {kind.sql}")))


def add(a: Column, b: Column, kind: LType) -> Column:
    """a + b of two integers of one type."""
    if kind.name in ("hugeint", "uhugeint"):
        (h1, l1), (h2, l2) = _huge_parts(a, kind), _huge_parts(b, kind)
        return _huge_text(h1 + h2, l1 + l2, kind)
    return integer(a.cast("decimal(38,0)") + b.cast("decimal(38,0)"), kind)


def subtract(a: Column, b: Column, kind: LType) -> Column:
    if kind.name in ("hugeint", "uhugeint"):
        (h1, l1), (h2, l2) = _huge_parts(a, kind), _huge_parts(b, kind)
        return _huge_text(h1 - h2, l1 - l2, kind)
    return integer(a.cast("decimal(38,0)") - b.cast("decimal(38,0)"), kind)


def negate(a: Column, kind: LType) -> Column:
    """-a; an unsigned value other than 0 has none."""
    if kind.name in ("hugeint", "uhugeint"):
        high, low = _huge_parts(a, kind)
        return _huge_text(-high, -low, kind)
    return integer(-a.cast("decimal(38,0)"), kind)


#: 128-bit integers are texts of up to 39 digits; sums go by parts above and below 18 digits.
_LOW = 18


def _huge_parts(x: Column, kind: LType) -> tuple[Column, Column]:
    """high and low of x = high * 10**18 + low, both of x's sign."""

    def split(x: Column) -> Column:
        ok = x.rlike(r"^-?[0-9]{1,39}$")
        sign = F.when(x.startswith("-"), -1).otherwise(1).cast("decimal(1,0)")
        valid = _checked(ok, F.lpad(F.regexp_replace(x, "^-", ""), 39, "0"), F.concat(x, F.lit(f" is no {kind.sql}")))
        part = lambda v, begin, n: (F.substring(v, begin, n).cast(f"decimal({n},0)") * sign).cast("decimal(24,0)")
        return _let(valid, lambda v: F.struct(part(v, 1, 39 - _LOW).alias("high"), part(v, 40 - _LOW, _LOW).alias("low")))

    parts = _let(x, split)
    return parts["high"], parts["low"]


def _huge_text(high: Column, low: Column, kind: LType) -> Column:
    """The canonical text of high * 10**18 + low, if it is in range."""
    unit = F.lit("1" + "0" * _LOW).cast("decimal(19,0)")
    pair = lambda h, w: F.struct(h.cast("decimal(24,0)").alias("high"), w.cast("decimal(24,0)").alias("low"))

    def carried(x: Column) -> Column:
        return _let(F.floor(x["low"] / unit).cast("decimal(24,0)"), lambda c: pair(x["high"] + c, x["low"] - c * unit))

    def signed(x: Column) -> Column:
        return F.when((x["high"] < 0) & (x["low"] > 0), pair(x["high"] + 1, x["low"] - unit)).otherwise(x)

    def text(x: Column) -> Column:
        least, most = INTEGERS[kind.name]
        h, w = x["high"], x["low"]
        body = F.when(h == 0, F.abs(w).cast("string")).otherwise(F.concat(F.abs(h).cast("string"), F.lpad(F.abs(w).cast("string"), _LOW, "0")))
        whole = F.concat(F.when((h < 0) | (w < 0), "-").otherwise(""), body)
        return _checked(_at_least(h, w, least) & ~_at_least(h, w, most + 1), whole, F.lit(f"out of range for {kind.sql}"))

    return _let(_let(_let(pair(high, low), carried), signed), text)


def _at_least(high: Column, low: Column, bound: int) -> Column:
    sign = -1 if bound < 0 else 1
    h, r = divmod(abs(bound), 10**_LOW)
    h, r = F.lit(str(sign * h)).cast("decimal(24,0)"), F.lit(str(sign * r)).cast("decimal(22,0)")
    return (high > h) | ((high == h) & (low >= r))


def huge_key(x: Column) -> Column:
    """A value that sorts as the 128-bit integers do whose texts x has."""
    digits = F.lpad(F.regexp_replace(x, "^-", ""), 39, "0")
    return F.when(x.startswith("-"), F.concat(F.lit("0"), F.translate(digits, "0123456789", "9876543210"))).otherwise(F.concat(F.lit("1"), digits))


def decimal(x: Column, width: int, scale: int) -> Column:
    """The number of a text or decimal at that width and scale; digits that do not fit are an error, none is rounded off."""
    text = F.trim(x.cast("string"))
    number = r"^[+-]?([0-9]+)(?:\.([0-9]*?)0*)?$"
    before = F.length(F.regexp_replace(F.regexp_extract(text, number, 1), "^0+", ""))
    after = F.length(F.regexp_extract(text, number, 2))
    ok = text.rlike(number) & (before <= width - scale) & (after <= scale)
    return _checked(ok, F.when(ok, text).cast(f"decimal({width},{scale})"), F.concat(text, F.lit(f" is no DECIMAL({width}, {scale})")))


def decimal_add(a: Column, b: Column, widths: tuple[int, int], scale: int, sign: int = 1) -> Column:
    """a + sign * b of decimals of one scale and these widths; the result is one digit wider than the wider."""
    if max(widths) > 37:
        raise OverflowError("the sum would need more than 38 digits")
    width = max(widths) + 1
    return (a + b if sign > 0 else a - b).cast(f"decimal({width},{scale})")


def interval(months: Column, days: Column, micros: Column) -> Column:
    """An interval; NULL if a part is."""
    parts = F.struct(months.cast("int").alias("months"), days.cast("int").alias("days"), micros.cast("long").alias("micros"))
    return F.when(months.isNotNull() & days.isNotNull() & micros.isNotNull(), parts)


def interval_add(a: Column, b: Column, sign: int = 1) -> Column:
    """a + sign * b, part by part: months, days and microseconds stay apart. A part out of range is an error."""
    plus = lambda k: a[k] + b[k] if sign > 0 else a[k] - b[k]  # noqa: E731  # overflow raises in ANSI mode, Spark's default
    return interval(plus("months"), plus("days"), plus("micros"))


def interval_negate(a: Column) -> Column:
    return interval(-a["months"], -a["days"], -a["micros"])


def bits(text: Column) -> Column:
    """The bits of a text of 0 and 1, from the highest of the first byte on."""

    def made(text: Column) -> Column:
        n = F.length(text)
        octets = lambda p: F.transform(F.sequence(F.lit(1), n, F.lit(8)), lambda i: F.lpad(F.conv(F.substring(p, i, F.lit(8)), 2, 16), 2, "0"))
        data = F.unhex(F.array_join(_let(F.rpad(text, (F.ceil(n / 8) * 8).cast("int"), F.lit("0")), octets), ""))
        return _checked(text.rlike("^[01]+$"), F.struct(data.alias("data"), n.alias("length")), F.concat(text, F.lit(" is no BIT")))

    return F.when(text.isNotNull(), _let(text, made))


def bits_text(x: Column) -> Column:
    """The text of 0 and 1 of bits."""
    four = lambda d: F.transform(F.sequence(F.lit(1), F.length(d)), lambda i: F.lpad(F.conv(F.substring(d, i, F.lit(1)), 16, 2), 4, "0"))
    return _let(x, lambda v: F.when(v.isNotNull(), F.substring(F.array_join(_let(F.hex(v["data"]), four), ""), F.lit(1), v["length"])))


def _by_bit(a: Column, b: Column, result: dict[str, str]) -> Column:
    def both(p: Column) -> Column:
        pairs = F.zip_with(F.split(p["x"], ""), F.split(p["y"], ""), lambda x, y: F.when(x != y, result["01"]).when(x == "1", result["11"]).otherwise(result["00"]))
        return _checked(F.length(p["x"]) == F.length(p["y"]), bits(F.array_join(pairs, "")), "bits of different lengths")

    return _let(F.struct(bits_text(a).alias("x"), bits_text(b).alias("y")), both)


def bits_and(a: Column, b: Column) -> Column:
    return _by_bit(a, b, {"00": "0", "01": "0", "11": "1"})


def bits_or(a: Column, b: Column) -> Column:
    return _by_bit(a, b, {"00": "0", "01": "1", "11": "1"})


def bits_xor(a: Column, b: Column) -> Column:
    return _by_bit(a, b, {"00": "0", "01": "1", "11": "0"})


def bits_not(a: Column) -> Column:
    return bits(F.translate(bits_text(a), "01", "10"))


def uuid(x: Column) -> Column:
    """A UUID's text in its canonical form."""
    text = F.lower(F.trim(x))
    return _checked(text.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"), text, F.concat(x, F.lit(" is no UUID")))


def enum(x: Column, kind: LType) -> Column:
    """x if it is one of the labels."""
    return _checked(x.isin(list(kind.names)), x, F.concat(x, F.lit(f" is no label of {kind.sql}")))


def enum_index(x: Column, kind: LType) -> Column:
    """The label's place, from 0; labels sort by it."""
    return F.when(x.isNotNull(), F.array_position(F.array(*map(F.lit, kind.names)), enum(x, kind)).cast("int") - 1)


def union_value(kind: LType, **member: Column) -> Column:
    """A union whose active member is the one given; it may be NULL and is active all the same."""
    ((tag, value),) = member.items()
    fields = [(value if n == tag else F.lit(None)).cast(child.spark).alias(n) for n, child in zip(kind.names, kind.children)]
    if tag not in kind.names:
        raise ValueError(f"{kind.sql} has no member {tag}")
    return F.struct(F.lit(tag).alias("tag"), *fields)


def union_tag(x: Column) -> Column:
    return x["tag"]


def union_extract(x: Column, tag: str) -> Column:
    """That member's value; NULL if another is active."""
    return x[tag]


def array_of(x: Column, size: int) -> Column:
    """x if it has that many items."""
    return _checked(F.size(x) == size, x, F.concat(F.lit(f"an array of {size} has not "), F.size(x).cast("string"), F.lit(" items")))
