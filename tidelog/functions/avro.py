"""Avro record schemas of tables, as JSON, without an Avro library."""

from __future__ import annotations

import json

from pyspark.sql import types as T

from .pgtypes import OIDS, PgColumn, numeric_typmod

# Avro types by column type. Others have none.
AVRO = {
    "bool": "boolean", "bytea": "bytes", "float4": "float", "float8": "double", "int8": "long", "int4": "int", "int2": "int", "text": "string",
    "varchar": "string", "jsonb": "bytes", "json": "bytes",
    "timestamptz": {"type": "long", "logicalType": "timestamp-micros"}, "timestamp": {"type": "long", "logicalType": "local-timestamp-micros"},
    "date": {"type": "int", "logicalType": "date"}, "uuid": {"type": "string", "logicalType": "uuid"},
}
_SPARK_AVRO = {
    T.BooleanType: "boolean", T.BinaryType: "bytes", T.FloatType: "float", T.DoubleType: "double", T.LongType: "long", T.IntegerType: "int",
    T.ShortType: "int", T.ByteType: "int", T.StringType: "string", T.TimestampType: AVRO["timestamptz"], T.TimestampNTZType: AVRO["timestamp"], T.DateType: AVRO["date"],
}


class SchemaError(ValueError):
    pass


def _record(name: str, fields: list[tuple[str, object]]) -> dict:
    return {"type": "record", "name": name, "fields": [{"name": n, "type": t} for n, t in sorted(fields)]}


def from_columns(name: str, columns: list[PgColumn], only: list[str] | None = None) -> dict:
    """Fields sorted by name, none nullable; ``only`` picks some. Types without a mapping are an error."""
    fields = []
    for c in columns:
        if only and c.name not in only:
            continue
        kind = OIDS.get(c.oid)
        if kind is None:
            raise SchemaError(f'column "{c.name}": type number {c.oid} is not known')
        if kind == "numeric":
            precision, scale = numeric_typmod(c.typmod)
            fields.append((c.name, {"type": "bytes", "logicalType": "decimal", "precision": precision, "scale": scale}))
        elif kind in AVRO:
            fields.append((c.name, AVRO[kind]))
        else:
            raise SchemaError(f'column "{c.name}": no Avro type for {kind}')
    return _record(name, fields)


def from_spark(name: str, schema: T.StructType, only: list[str] | None = None) -> dict:
    fields = []
    for f in schema.fields:
        if only and f.name not in only:
            continue
        if isinstance(f.dataType, T.DecimalType):
            fields.append((f.name, {"type": "bytes", "logicalType": "decimal", "precision": f.dataType.precision, "scale": f.dataType.scale}))
        elif type(f.dataType) in _SPARK_AVRO:
            fields.append((f.name, _SPARK_AVRO[type(f.dataType)]))
        else:
            raise SchemaError(f'column "{f.name}": no Avro type for {f.dataType.simpleString()}')
    return _record(name, fields)


def to_json(schema: dict) -> str:
    return json.dumps(schema, separators=(",", ":"))


def payload_and_key(table: str, schema: T.StructType, key: str) -> tuple[dict, dict]:
    return from_spark(f"{table}_payload", schema), from_spark(f"{table}_key", schema, [key])


class Registry:
    """Versions of schemas by subject, from 1; a schema equal to the last one keeps its version."""

    def __init__(self) -> None:
        self.versions: dict[str, list[str]] = {}

    def register(self, schema: dict) -> tuple[str, int]:
        own = self.versions.setdefault(schema["name"], [])
        text = to_json(schema)
        if text not in own:
            own.append(text)
        return schema["name"], own.index(text) + 1
