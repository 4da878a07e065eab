"""Database column types: their Spark types, and expressions that decode and format values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type identifiers of the PostgreSQL catalog.
OIDS = {
    16: "bool", 17: "bytea", 20: "int8", 21: "int2", 23: "int4", 25: "text", 114: "json", 142: "xml", 600: "point", 601: "lseg", 602: "path", 603: "box",
    604: "polygon", 628: "line", 650: "cidr", 700: "float4", 701: "float8", 718: "circle", 774: "macaddr8", 790: "money", 829: "macaddr", 869: "inet",
    1042: "bpchar", 1043: "varchar", 1082: "date", 1083: "time", 1114: "timestamp", 1184: "timestamptz", 1186: "interval", 1266: "timetz", 1560: "bit",
    1562: "varbit", 1700: "numeric", 2950: "uuid", 3220: "pg_lsn", 3614: "tsvector", 3615: "tsquery", 3802: "jsonb", 5038: "pg_snapshot",
}
_NAMES = {name: oid for oid, name in OIDS.items()}
# Other names of the same types.
_ALIASES = {
    "boolean": "bool", "smallint": "int2", "integer": "int4", "int": "int4", "bigint": "int8", "smallserial": "int2", "serial2": "int2", "serial": "int4",
    "serial4": "int4", "bigserial": "int8", "serial8": "int8", "real": "float4", "double precision": "float8", "character varying": "varchar", "character": "bpchar",
    "char": "bpchar", "decimal": "numeric", "timestamp without time zone": "timestamp", "timestamp with time zone": "timestamptz", "time without time zone": "time",
    "time with time zone": "timetz", "bit varying": "varbit",
}

_SPARK = {
    "bool": T.BooleanType(), "bytea": T.BinaryType(), "int8": T.LongType(), "int2": T.ShortType(), "int4": T.IntegerType(), "float4": T.FloatType(),
    "float8": T.DoubleType(), "json": T.BinaryType(), "jsonb": T.BinaryType(), "date": T.DateType(), "timestamp": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(), "time": T.LongType(),
    "interval": T.StructType([T.StructField("months", T.IntegerType()), T.StructField("days", T.IntegerType()), T.StructField("microseconds", T.LongType())]),
    "bit": T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("len", T.IntegerType())]),
    "varbit": T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("len", T.IntegerType())]),
    "point": T.ArrayType(T.DoubleType()), "line": T.ArrayType(T.DoubleType()), "lseg": T.ArrayType(T.DoubleType()), "box": T.ArrayType(T.DoubleType()),
    "path": T.ArrayType(T.DoubleType()), "polygon": T.ArrayType(T.DoubleType()), "circle": T.ArrayType(T.DoubleType()),
    "macaddr": T.BinaryType(), "macaddr8": T.BinaryType(),
}


@dataclass(frozen=True)
class PgColumn:
    """A column as a relation describes it."""

    name: str
    oid: int
    typmod: int = -1
    key: bool = False

    @property
    def type_name(self) -> str:
        return OIDS.get(self.oid, "unknown")


def canonical(name: str) -> str:
    name = name.lower().split("(")[0].strip()
    return _ALIASES.get(name, name)


def oid_of(name: str) -> int:
    return _NAMES[canonical(name)]


def numeric_typmod(typmod: int) -> tuple[int, int]:
    """(precision, scale) that a type modifier encodes; -1 gives (65535, 65531)."""
    return (typmod - 4) >> 16 & 65535, typmod - 4 & 65535


def spark_type(oid: int, typmod: int = -1) -> T.DataType:
    """The Spark type of a column; unknown types, and numerics beyond 38 digits, are strings."""
    name = OIDS.get(oid)
    if name == "numeric":
        precision, scale = numeric_typmod(typmod)
        return T.DecimalType(precision, scale) if typmod >= 0 and 0 < precision <= 38 and scale <= precision else T.StringType()
    return _SPARK.get(name, T.StringType())


def spark_schema(columns: list[PgColumn]) -> T.StructType:
    return T.StructType([T.StructField(c.name, spark_type(c.oid, c.typmod)) for c in columns])


def _floats(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(r"([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)"), F.lit(1)), lambda x: x.cast("double"))


def _interval(text: Column) -> Column:
    """``1 year 2 mons 3 days -04:05:06.7`` as months, days and microseconds."""
    whole = lambda pattern: F.coalesce(F.regexp_extract(text, pattern, 1).try_cast("bigint"), F.lit(0))
    clock = F.regexp_extract(text, r"([-+]?)(\d+):(\d+):(\d+(?:\.\d+)?)", 0)
    part = lambda i: F.coalesce(F.regexp_extract(text, r"([-+]?)(\d+):(\d+):(\d+(?:\.\d+)?)", i).try_cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))
    sign = F.when(clock.startswith("-"), -1).otherwise(1)
    micros = (part(2) * 3600 + part(3) * 60 + part(4)) * 1_000_000 * sign
    months = whole(r"([-+]?\d+) year") * 12 + whole(r"([-+]?\d+) mon")
    return F.struct(months.cast("int").alias("months"), whole(r"([-+]?\d+) day").cast("int").alias("days"), micros.cast("bigint").alias("microseconds"))


def _bits(text: Column) -> Column:
    padded = F.rpad(text, F.lit(8) * F.ceil(F.length(text) / F.lit(8.0)).cast("int"), F.lit("0"))
    bytes_ = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), (F.length(padded) / 8).cast("int") - 1)),
        lambda i: F.lpad(F.conv(F.substr(padded, i * 8 + 1, F.lit(8)), 2, 16), 2, "0"),
    )
    hexed = F.when(F.length(text) == 0, "").otherwise(F.array_join(bytes_, ""))
    return F.struct(F.unhex(hexed).alias("bytes"), F.length(text).alias("len"))


def decode_text(text: Column, oid: int, typmod: int = -1) -> Column:
    """The value of a column that the change feed carries as text; null stays null."""
    name, kind = OIDS.get(oid), spark_type(oid, typmod)
    if name == "bool":
        value = F.when(text.isin("t", "true"), True).when(text.isin("f", "false"), False)
    elif name == "bytea":
        value = F.when(text.startswith("\\x"), F.unhex(F.substring(text, 3, 2**31 - 1))).otherwise(F.encode(text, "UTF-8"))
    elif name in ("json", "jsonb"):
        value = F.encode(text, "UTF-8")
    elif name == "numeric" and isinstance(kind, T.DecimalType):
        value = F.when(text.isin("NaN", "Infinity", "-Infinity"), None).otherwise(text.cast(kind))
    elif name == "numeric":
        value = F.when(text.isin("NaN", "Infinity", "-Infinity"), None).otherwise(text)
    elif name == "timestamptz":
        value = F.regexp_replace(text, r"([-+]\d\d)$", "$1:00").cast(kind)
    elif name == "time":
        parts = F.split(text, ":")
        seconds = parts[0].cast("bigint") * 3600 + parts[1].cast("bigint") * 60
        value = seconds * 1_000_000 + (parts[2].cast("decimal(18,6)") * 1_000_000).cast("bigint")
    elif name == "interval":
        value = _interval(text)
    elif name in ("bit", "varbit"):
        value = _bits(text)
    elif name in ("macaddr", "macaddr8"):
        value = F.unhex(F.regexp_replace(text, "[^0-9A-Fa-f]", ""))
    elif name in ("point", "line", "lseg", "box", "path", "polygon", "circle"):
        value = _floats(text)
    elif name in ("inet", "cidr"):
        bare = F.when(text.contains("/"), text)
        value = bare.otherwise(F.concat(text, F.when(text.contains(":"), "/128").otherwise("/32")))
    elif isinstance(kind, T.StringType):
        value = text
    else:
        value = text.cast(kind)
    return F.when(text.isNotNull(), value)


def uuid_text(raw: Column, null_as_empty: bool = False) -> Column:
    """16 bytes in the form 8-4-4-4-12; with ``null_as_empty`` a null is an empty text."""
    h = F.lower(F.hex(raw))
    cut = lambda a, n: F.substring(h, a, n)
    text = F.when(F.length(h) == 32, F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12))).when(
        raw.isNotNull(), F.raise_error(F.lit("failed to parse uuid byte array"))
    )
    return F.coalesce(text, F.lit("")) if null_as_empty else text


def format_numeric(value: Column, scale: int | None, compat: bool = False) -> Column:
    """A decimal at the target column's scale, halves away from zero, at whatever precision it has (up to 38 digits).

    Columns without a declared scale keep the value; with ``compat`` they take scale
    0, so the fraction is rounded away.
    """
    if scale is None:
        scale = 0 if compat else None
    return value if scale is None else F.round(value, scale)


def format_value(value: Column, oid: int, null_uuid_as_empty: bool = False) -> Column:
    """How a value leaves the source: uuids as text, xml bytes as text, all else as it is."""
    name = OIDS.get(oid)
    if name == "uuid":
        return F.coalesce(value, F.lit("")) if null_uuid_as_empty else value
    if name == "xml":
        return value.cast("string")
    return value


def is_integer_key(kind: T.DataType) -> bool:
    return isinstance(kind, T.ShortType | T.IntegerType | T.LongType)


def key_value(key: Column) -> Column:
    """Any integer key as a bigint."""
    return key.cast("bigint")
