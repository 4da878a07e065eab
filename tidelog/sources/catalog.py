"""Tables and keys: listing, lookup, checks, quoting, publications."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pgtypes import is_integer_key
from .options import ALL_TABLES


class CatalogError(ValueError):
    pass


#: Fixed value: the SQL state of creating what is there already.
DUPLICATE_OBJECT = "42710"


def is_duplicate(error: Exception) -> bool:
    """The database says that what was to be created is there already; callers go on with a warning."""
    states = [getattr(error, "sqlstate", None), getattr(getattr(error, "java_exception", None), "getSQLState", lambda: None)()]
    return DUPLICATE_OBJECT in states


def slot_state(slots: DataFrame, name: str) -> dict:
    """A replication slot's row from the catalog (slot, confirmed_flush_lsn, restart_lsn); a missing slot is an error."""
    found = slots.where(F.col("slot") == name).limit(1).collect()
    if not found:
        raise CatalogError(f'no replication slot "{name}"')
    return found[0].asDict()


def quote_ident(name: str) -> str:
    """An identifier in double quotes; quotes inside are doubled."""
    return '"' + name.replace('"', '""') + '"'


def quote_column(name: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))


def tables_of(spark: SparkSession, wanted: list[str], database: str | None = None) -> list[str]:
    """The wanted tables; ``*`` is every table of the database."""
    if wanted != [ALL_TABLES]:
        return list(wanted)
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary or database is None)


def primary_keys(attributes: DataFrame, indexes: DataFrame, table: str) -> DataFrame:
    """Key columns of a table from catalog rows: attributes (table, number, name), indexes (table, numbers, is_primary)."""
    i, a = indexes.where((F.col("table") == table) & F.col("is_primary")).alias("i"), attributes.alias("a")
    same = (F.col("a.table") == F.col("i.table")) & F.array_contains(F.col("i.numbers"), F.col("a.number"))
    return a.join(i, same).select(F.col("a.name").alias("name"))


def single_key(table: str, columns: list[str]) -> str:
    if not columns:
        raise CatalogError(f'table "{table}" has no primary keys')
    if len(columns) > 1:
        raise CatalogError(f'composite keys are not supported: table "{table}" has {", ".join(columns)}')
    return columns[0]


def require_keys(tables: list[str], keys: dict[str, str]) -> None:
    missing = [f'missing key for table "{t}"' for t in tables if not keys.get(t)]
    if missing:
        raise CatalogError("\n".join(missing))


def check_table(frames: dict[str, DataFrame], table: str, key: str) -> None:
    """The table is there, and its key is an integer column of it."""
    if table not in frames:
        raise CatalogError(f'table "{table}" does not exist')
    check_key(frames[table].schema, table, key)


# What error messages call types.
_SHOWN = {"smallint": "smallint", "int": "integer", "bigint": "bigint", "string": "text", "boolean": "boolean", "double": "double precision", "float": "real", "binary": "bytea"}


def check_key(schema: T.StructType, table: str, key: str) -> None:
    if key not in schema.names:
        raise CatalogError(f'key "{key}" not present on table "{table}"')
    kind = schema[key].dataType
    if not is_integer_key(kind):
        raise CatalogError(f'key "{key}" of type "{_SHOWN.get(kind.simpleString(), kind.simpleString())}" is unsupported')


def numeric_scale(schema: T.StructType, column: str) -> int | None:
    """Scale of a decimal column; None where none is declared."""
    kind = schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return kind.scale
    if isinstance(kind, T.StringType):
        return None
    raise CatalogError(f'column "{column}" is not numeric')


def key_uniqueness(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(tbl, is_unique): whether a column could be the table's key. Counting by key combines before the shuffle."""
    parts = []
    for name, (df, key) in tables.items():
        counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        nulls = df.where(F.col(key).isNull()).agg(F.count("*").alias("n"))
        repeated = counts.agg(F.coalesce(F.max("n"), F.lit(1)).alias("n")).unionByName(nulls.select((F.col("n") + 1).alias("n")))
        parts.append(repeated.agg((F.max("n") <= 1).alias("is_unique")).select(F.lit(name).alias("tbl"), "is_unique"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass
class Publications:
    """Named table sets, as a feed publishes them."""

    tables: dict[str, list[str]] = field(default_factory=dict)

    def create(self, name: str, tables: list[str]) -> bool:
        """False, and a warning, if there was one of that name, which stays."""
        if not tables:
            raise CatalogError(f'publication "{name}" requires at least one table')
        if name in self.tables:
            warnings.warn(f'publication "{name}" is there already and stays as it is', stacklevel=2)
            return False
        self.tables[name] = list(tables)
        return True

    def drop(self, name: str, if_exists: bool = False) -> None:
        if name not in self.tables and not if_exists:
            raise CatalogError(f'publication "{name}" does not exist')
        self.tables.pop(name, None)

    @staticmethod
    def statement(name: str, tables: list[str], parameters: dict[str, str] | None = None) -> str:
        if not tables:
            raise CatalogError(f'publication "{name}" requires at least one table')
        given = " WITH (" + ", ".join(f"{k}='{v}'" for k, v in parameters.items()) + ")" if parameters else ""
        return f"CREATE PUBLICATION {quote_ident(name)} FOR TABLE {', '.join(map(quote_ident, tables))}{given}"
