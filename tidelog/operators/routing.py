"""Which table a record goes to, and how its parts are put in form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.options import SinkOptions


def target_table(option: str) -> Column:
    """A static name, or the expression between {{ and }} over the record's columns."""
    sink = SinkOptions(url="spark://local", table=option).validate()
    return F.expr(sink.expression) if sink.is_template else F.lit(sink.table)


def routed(recs: DataFrame, option: str) -> DataFrame:
    return recs.withColumn("target_table", target_table(option))


def for_each_table(recs: DataFrame, option: str, write: Callable[[str, DataFrame], None]) -> list[str]:
    """Calls ``write`` with each target's records; names come to the driver, records don't."""
    parts = routed(recs, option)
    names = sorted(r["target_table"] for r in parts.select("target_table").distinct().collect())
    for name in names:
        write(name, parts.where(F.col("target_table") == name).drop("target_table"))
    return names


def has_key(key: Column, kind: T.DataType) -> Column:
    """There is a key and it is not empty."""
    if isinstance(kind, T.MapType):
        return F.coalesce(F.size(key) > 0, F.lit(False))
    if isinstance(kind, T.StructType):
        found = F.lit(False)
        for n in kind.names:
            found = found | key[n].isNotNull()
        return key.isNotNull() & found
    return key.isNotNull()


def structured(raw: Column, schema: T.StructType) -> Column:
    """JSON bytes or text as a struct: empty and null give a struct of nulls, bad JSON an error. Integers stay exact."""
    text = F.coalesce(raw.cast("string"), F.lit(""))
    parsed = F.from_json(text, schema, {"mode": "FAILFAST"})
    return F.when(F.trim(text) == "", F.from_json(F.lit("{}"), schema)).otherwise(parsed)


def columns_and_values(key: dict[str, Column], payload: dict[str, Column]) -> list[Column]:
    """The columns of an upsert: the key's first, then those of the payload that are not in the key."""
    return [v.alias(n) for n, v in key.items()] + [v.alias(n) for n, v in payload.items() if n not in key]
