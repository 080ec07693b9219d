"""Type descriptors: 23 scalar types and seven constructed kinds, their text forms, and how Spark stores them."""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import types as T

#: Nesting that a descriptor may have.
MAX_DEPTH = 64

_INTERVAL = T.StructType([T.StructField("months", T.IntegerType()), T.StructField("days", T.IntegerType()), T.StructField("micros", T.LongType())])
_BITS = T.StructType([T.StructField("data", T.BinaryType()), T.StructField("length", T.IntegerType())])

#: token: SQL name, Spark type. Unsigned and 128-bit integers have no Spark type of their own.
_SCALARS: dict[str, tuple[str, T.DataType]] = {
    "bool": ("BOOLEAN", T.BooleanType()),
    "i8": ("TINYINT", T.ByteType()),
    "u8": ("UTINYINT", T.ShortType()),
    "i16": ("SMALLINT", T.ShortType()),
    "u16": ("USMALLINT", T.IntegerType()),
    "i32": ("INTEGER", T.IntegerType()),
    "u32": ("UINTEGER", T.LongType()),
    "i64": ("BIGINT", T.LongType()),
    "u64": ("UBIGINT", T.DecimalType(20, 0)),
    "f32": ("FLOAT", T.FloatType()),
    "f64": ("DOUBLE", T.DoubleType()),
    "varchar": ("VARCHAR", T.StringType()),
    "blob": ("BLOB", T.BinaryType()),
    "geometry": ("GEOMETRY", T.BinaryType()),
    "variant": ("VARIANT", T.VariantType()),
    "date": ("DATE", T.DateType()),
    "time": ("TIME", T.TimeType(6)),
    "timestamp": ("TIMESTAMP", T.TimestampNTZType()),
    "hugeint": ("HUGEINT", T.StringType()),
    "uhugeint": ("UHUGEINT", T.StringType()),
    "uuid": ("UUID", T.StringType()),
    "interval": ("INTERVAL", _INTERVAL),
    "bit": ("BIT", _BITS),
}

#: Bounds of the integer types.
INTEGERS = {f"{sign}{n}": (-(1 << n - 1), (1 << n - 1) - 1) if sign == "i" else (0, (1 << n) - 1) for sign in "iu" for n in (8, 16, 32, 64)}
INTEGERS |= {"hugeint": (-(1 << 127), (1 << 127) - 1), "uhugeint": (0, (1 << 128) - 1)}


@dataclass(frozen=True)
class LType:
    """A descriptor. ``t[n]`` is an array of n values, ``t[:]`` a list."""

    kind: str
    name: str = ""
    children: tuple[LType, ...] = ()
    names: tuple[str, ...] = ()
    parameters: tuple[int, ...] = ()

    def __getitem__(self, n: int | slice) -> LType:
        return LIST(self) if isinstance(n, slice) else ARRAY(self, n)

    def __repr__(self) -> str:
        return self.sql

    @property
    def size(self) -> int | None:
        return self.parameters[0] if self.kind == "array" else None

    @property
    def depth(self) -> int:
        return 1 + max((x.depth for x in self.children), default=0)

    @property
    def token(self) -> str:
        """The text form that parse() reads."""
        inner = [x.token for x in self.children]
        match self.kind:
            case "scalar":
                return self.name
            case "decimal":
                return f"decimal<{self.parameters[0]};{self.parameters[1]}>"
            case "enum":
                return f"enum<{'|'.join(quote(x, safe='') for x in self.names)}>"
            case "array":
                return f"{inner[0]}[{self.parameters[0]}]"
            case "struct" | "union":
                return f"{self.kind}<{';'.join(f'{quote(n, safe='')}:{x}' for n, x in zip(self.names, inner))}>"
        return f"{self.kind}<{';'.join(inner)}>"

    @property
    def sql(self) -> str:
        """The type as SQL writes it."""
        inner = [x.sql for x in self.children]
        match self.kind:
            case "scalar":
                return _SCALARS[self.name][0]
            case "decimal":
                return f"DECIMAL({self.parameters[0]}, {self.parameters[1]})"
            case "enum":
                return f"ENUM({', '.join("'" + x.replace("'", "''") + "'" for x in self.names)})"
            case "list":
                return f"{inner[0]}[]"
            case "array":
                return f"{inner[0]}[{self.parameters[0]}]"
            case "map":
                return f"MAP({inner[0]}, {inner[1]})"
        fields = ", ".join(f"{_name(n)} {x}" for n, x in zip(self.names, inner))
        return f"{self.kind.upper()}({fields})"

    @property
    def spark(self) -> T.DataType:
        """How Spark stores the type. A union is a struct of its tag and a field for each member."""
        inner = [x.spark for x in self.children]
        match self.kind:
            case "scalar":
                return _SCALARS[self.name][1]
            case "decimal":
                return T.DecimalType(*self.parameters)
            case "enum":
                return T.StringType()
            case "list" | "array":
                return T.ArrayType(inner[0])
            case "map":
                return T.MapType(inner[0], inner[1])
            case "union":
                return T.StructType([T.StructField("tag", T.StringType()), *(T.StructField(n, x) for n, x in zip(self.names, inner))])
        return T.StructType([T.StructField(n, x) for n, x in zip(self.names, inner)])

    @property
    def field_metadata(self) -> dict[str, str]:
        """For a StructField, so that the descriptor survives in a schema."""
        return {"ltype": self.token}


def _name(x: str) -> str:
    return x if re.fullmatch(r"[A-Za-z_]\w*", x) else '"' + x.replace('"', '""') + '"'


def _checked(x: LType) -> LType:
    if x.depth > MAX_DEPTH:
        raise ValueError(f"a type may be nested {MAX_DEPTH} levels deep")
    return x


def _distinct(what: str, names: tuple[str, ...]) -> None:
    if not names or len(set(names)) < len(names) or not all(isinstance(x, str) and x for x in names):
        raise ValueError(f"{what} needs distinct names that are not empty")


def _types(*children: LType) -> None:
    for x in children:
        if not is_type(x):
            raise TypeError(f"not a type: {x!r}")


BOOL, I8, U8, I16, U16, I32, U32, I64, U64, F32, F64, VARCHAR, BLOB, GEOMETRY, VARIANT, DATE, TIME, TIMESTAMP, HUGEINT, UHUGEINT, UUID, INTERVAL, BIT = (LType("scalar", x) for x in _SCALARS)
SCALARS = {x.name: x for x in (BOOL, I8, U8, I16, U16, I32, U32, I64, U64, F32, F64, VARCHAR, BLOB, GEOMETRY, VARIANT, DATE, TIME, TIMESTAMP, HUGEINT, UHUGEINT, UUID, INTERVAL, BIT)}


def DECIMAL(width: int, scale: int) -> LType:
    if not (isinstance(width, int) and isinstance(scale, int) and 1 <= width <= 38 and 0 <= scale <= width):
        raise ValueError("DECIMAL has a width of 1 to 38 and a scale of 0 to its width")
    return LType("decimal", parameters=(width, scale))


def ENUM(*labels: str) -> LType:
    _distinct("ENUM", labels)
    return LType("enum", names=labels)


def LIST(child: LType) -> LType:
    _types(child)
    return _checked(LType("list", children=(child,)))


def ARRAY(child: LType, size: int) -> LType:
    _types(child)
    if not isinstance(size, int) or isinstance(size, bool) or size < 1:
        raise ValueError("ARRAY has a positive size")
    return _checked(LType("array", children=(child,), parameters=(size,)))


def MAP(key: LType, value: LType) -> LType:
    _types(key, value)
    return _checked(LType("map", children=(key, value)))


def STRUCT(**fields: LType) -> LType:
    _distinct("STRUCT", tuple(fields))
    _types(*fields.values())
    return _checked(LType("struct", children=tuple(fields.values()), names=tuple(fields)))


def UNION(**members: LType) -> LType:
    _distinct("UNION", tuple(members))
    if len(members) > 255 or "tag" in members:
        raise ValueError("UNION has at most 255 members, none named tag")
    _types(*members.values())
    return _checked(LType("union", children=tuple(members.values()), names=tuple(members)))


def is_type(x: object) -> bool:
    """Whether x is a sound descriptor, to its last child."""
    if not isinstance(x, LType) or x.depth > MAX_DEPTH or not all(map(is_type, x.children)):
        return False
    match x.kind:
        case "scalar":
            return x.name in _SCALARS and not x.children
        case "decimal":
            return len(x.parameters) == 2 and 1 <= x.parameters[0] <= 38 and 0 <= x.parameters[1] <= x.parameters[0]
        case "enum":
            return bool(x.names) and len(set(x.names)) == len(x.names) and all(x.names)
        case "list":
            return len(x.children) == 1
        case "array":
            return len(x.children) == 1 and len(x.parameters) == 1 and x.parameters[0] >= 1
        case "map":
            return len(x.children) == 2
        case "struct" | "union":
            return bool(x.names) and len(set(x.names)) == len(x.names) == len(x.children)
    return False


def normalize(x: LType | str) -> LType:
    """A descriptor, or the scalar type of that token or SQL name; texts of constructed types are for parse()."""
    if isinstance(x, str):
        low = x.strip().lower()
        found = SCALARS.get(low) or next((SCALARS[k] for k, (sql, _) in _SCALARS.items() if sql.lower() == low), None)
        if found is None:
            raise ValueError(f"not a scalar type: {x!r}")
        return found
    if not is_type(x):
        raise TypeError(f"not a type: {x!r}")
    return x


def signature(name: str, args: list[LType] | None, returns: LType) -> str:
    return f"{name}({'...' if args is None else ', '.join(x.sql for x in args)}) -> {returns.sql}"


def parse(token: str) -> LType:
    """The descriptor of a token, as ``LType.token`` writes it."""
    sized = re.fullmatch(r"(.*)\[(\d+)\]", token)
    if sized:
        return ARRAY(parse(sized[1]), int(sized[2]))
    if token in SCALARS:
        return SCALARS[token]
    m = re.fullmatch(r"(\w+)<(.*)>", token, re.S)
    if not m:
        raise ValueError(f"not a type token: {token!r}")
    parts, level, begin = [], 0, 0
    for i, c in enumerate(m[2]):
        level += (c == "<") - (c == ">")
        if c == ";" and not level:
            parts.append(m[2][begin:i])
            begin = i + 1
    parts.append(m[2][begin:])
    match m[1], len(parts):
        case "decimal", 2:
            return DECIMAL(int(parts[0]), int(parts[1]))
        case "enum", 1:
            return ENUM(*map(unquote, m[2].split("|")))
        case "list", 1:
            return LIST(parse(parts[0]))
        case "map", 2:
            return MAP(parse(parts[0]), parse(parts[1]))
        case ("struct" | "union"), _:
            named = [x.partition(":") for x in parts]
            return (STRUCT if m[1] == "struct" else UNION)(**{unquote(n): parse(x) for n, _, x in named})
    raise ValueError(f"not a type token: {token!r}")


def from_spark(x: T.DataType) -> LType:
    """The descriptor that a Spark type has by itself."""
    match x:
        case T.DecimalType():
            return DECIMAL(x.precision, x.scale)
        case T.ArrayType():
            return LIST(from_spark(x.elementType))
        case T.MapType():
            return MAP(from_spark(x.keyType), from_spark(x.valueType))
        case T.TimestampType():
            return TIMESTAMP
        case T.StructType():
            return INTERVAL if x == _INTERVAL else BIT if x == _BITS else STRUCT(**{f.name: from_spark(f.dataType) for f in x})
    names = {"ByteType": I8, "ShortType": I16, "IntegerType": I32, "LongType": I64, "FloatType": F32, "DoubleType": F64, "StringType": VARCHAR, "BinaryType": BLOB, "BooleanType": BOOL, "DateType": DATE, "TimeType": TIME, "TimestampNTZType": TIMESTAMP, "VariantType": VARIANT}
    if type(x).__name__ not in names:
        raise TypeError(f"no type for {x.simpleString()}; cast the argument to a concrete type")
    return names[type(x).__name__]
