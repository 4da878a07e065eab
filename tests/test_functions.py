import datetime as dt
import json
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import avro, pgtypes, position
from tidelog.functions.position import Position, PositionError, PositionType, SnapshotPosition


def test_position_json():
    p = Position(PositionType.SNAPSHOT, {"orders": SnapshotPosition(1, 2)}, "4/137515E8")
    text = '{"type":1,"snapshots":{"orders":{"last_read":1,"snapshot_end":2}},"last_lsn":"4/137515E8"}'
    assert p.to_json() == text
    assert position.parse_position(text) == p
    assert position.parse_position("") == Position()
    assert position.parse_position(None).type == PositionType.INITIAL


@pytest.mark.parametrize("text", ["{", "[", '{"type":1'])
def test_bad_position(text):
    with pytest.raises(PositionError, match="invalid position: unexpected end of JSON input"):
        position.parse_position(text)


def test_lsn():
    assert position.parse_lsn("4/137515E8") == 17506309608
    assert position.parse_lsn("") == 0
    for bad in ("invalid", "1", "x/1", "1/1FFFFFFFF"):
        with pytest.raises(PositionError, match="failed to parse LSN: expected integer"):
            position.parse_lsn(bad)


@given(st.integers(0, 2**64 - 1))
def test_lsn_round_trip(n):
    assert position.parse_lsn(position.format_lsn(n)) == n


def test_lsn_columns(spark):
    values = [0, 1, 17506309608, 2**63 - 1, 2**32, 2**32 - 1]
    df = spark.createDataFrame([(v,) for v in values], "n long")
    rows = df.select("n", position.lsn_text(F.col("n")).alias("t")).select("*", position.lsn_value(F.col("t")).alias("back")).collect()
    assert all(r.back == r.n and r.t == position.format_lsn(r.n) for r in rows)


def test_ack():
    assert position.validate_ack('{"type":2,"last_lsn":"0/2A"}') == 42
    with pytest.raises(PositionError, match='invalid type "Snapshot" for CDC position'):
        position.validate_ack('{"type":1}')
    with pytest.raises(PositionError, match="cannot ack zero position"):
        position.validate_ack('{"type":2}')
    assert position.type_name(7) == "Type(7)"


def test_progress_reports():
    p = position.Progress(written=10, server_end=20)
    p.ack('{"type":2,"last_lsn":"0/A"}')
    assert p.report() == 20
    p.written = 15
    assert p.report() == 10
    p.written = 5
    with pytest.raises(PositionError):
        p.report()


def _decode(spark, oid, text, typmod=-1):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(pgtypes.decode_text(F.col("t"), oid, typmod).alias("v")).first().v


def test_decode_text(spark):
    o = pgtypes.oid_of
    cases = [
        ("boolean", "t", True), ("boolean", "f", False), ("smallint", "32767", 32767), ("integer", "-5", -5), ("bigint", "9223372036854775807", 2**63 - 1),
        ("bytea", "\\x07ff", b"\x07\xff"), ("text", "foo bar", "foo bar"), ("char", "8  ", "8  "), ("json", '{"a": 1}', b'{"a": 1}'), ("date", "2022-03-14", dt.date(2022, 3, 14)),
        ("timestamp", "2022-03-14 15:16:17", dt.datetime(2022, 3, 14, 15, 16, 17)), ("time", "01:02:03.5", (3723 * 10**6 + 500_000)), ("timetz", "01:02:03+02", "01:02:03+02"),
        ("uuid", "bd94ee0b-564f-4088-bf4e-8d5e626caf66", "bd94ee0b-564f-4088-bf4e-8d5e626caf66"), ("money", "$28.00", "$28.00"), ("inet", "192.168.0.1", "192.168.0.1/32"),
        ("inet", "10.0.0.0/8", "10.0.0.0/8"), ("macaddr", "08:00:2b:01:02:03", bytes.fromhex("08002b010203")), ("point", "(5,-6.5)", [5.0, -6.5]),
        ("interval", "1 year 2 mons 3 days 04:05:06.5", (14, 3, (4 * 3600 + 5 * 60 + 6) * 10**6 + 500_000)), ("interval", "00:00:18", (0, 0, 18_000_000)), ("bit", "10101010", (b"\xaa", 8)),
        ("varbit", "101", (b"\xa0", 3)), ("pg_lsn", "4/137515E8", "4/137515E8"), ("xml", "<a>1</a>", "<a>1</a>"),
    ]
    for name, text, want in cases:
        got = _decode(spark, o(name), text)
        assert (tuple(got) if isinstance(want, tuple) else bytes(got) if isinstance(want, bytes) else got) == want, name
        assert _decode(spark, o(name), None) is None
    assert _decode(spark, 1184, "2022-03-14 15:16:17-08").astimezone(dt.UTC) == dt.datetime(2022, 3, 14, 23, 16, 17, tzinfo=dt.UTC)
    typmod = (8 << 16 | 2) + 4
    assert _decode(spark, 1700, "292929.29", typmod) == Decimal("292929.29")
    assert _decode(spark, 1700, "NaN", typmod) is None
    assert _decode(spark, 1700, "12345678901234567890.123", -1) == "12345678901234567890.123"
    assert _decode(spark, 999999, "whatever") == "whatever"


def test_numeric():
    assert pgtypes.numeric_typmod(-1) == (65535, 65531)
    assert pgtypes.numeric_typmod((16 << 16 | 3) + 4) == (16, 3)
    assert pgtypes.spark_type(1700, (16 << 16 | 3) + 4) == T.DecimalType(16, 3)
    assert pgtypes.spark_type(1700, (60 << 16 | 3) + 4) == T.StringType()


def test_format_numeric(spark):
    df = spark.createDataFrame([(Decimal("2.5"),), (Decimal("-2.5"),), (Decimal("1.005"),), (None,)], "v decimal(18,4)")
    assert [r[0] for r in df.select(pgtypes.format_numeric(F.col("v"), None, compat=True)).collect()] == [3, -3, 1, None]
    assert [r[0] for r in df.select(pgtypes.format_numeric(F.col("v"), 2)).collect()][2] == Decimal("1.01")
    assert [r[0] for r in df.select(pgtypes.format_numeric(F.col("v"), None)).collect()][0] == Decimal("2.5")


def test_uuid_text(spark):
    raw = bytes.fromhex("bd94ee0b564f4088bf4e8d5e626caf66")
    df = spark.createDataFrame([(raw,), (None,)], "v binary")
    assert [r[0] for r in df.select(pgtypes.uuid_text(F.col("v"))).collect()] == ["bd94ee0b-564f-4088-bf4e-8d5e626caf66", None]
    assert [r[0] for r in df.select(pgtypes.uuid_text(F.col("v"), True)).collect()][1] == ""
    with pytest.raises(Exception, match="failed to parse uuid"):
        spark.createDataFrame([(b"123",)], "v binary").select(pgtypes.uuid_text(F.col("v"))).collect()


def test_avro_schema():
    columns = [
        pgtypes.PgColumn("id", 20), pgtypes.PgColumn("key", 17), pgtypes.PgColumn("column1", 1043), pgtypes.PgColumn("column4", 1700, (16 << 16 | 3) + 4),
        pgtypes.PgColumn("UppercaseColumn1", 23), pgtypes.PgColumn("at", 1184),
    ]
    got = avro.from_columns("t_payload", columns)
    assert [f["name"] for f in got["fields"]] == ["UppercaseColumn1", "at", "column1", "column4", "id", "key"]
    assert got["fields"][3]["type"] == {"type": "bytes", "logicalType": "decimal", "precision": 16, "scale": 3}
    assert avro.from_columns("t_key", columns, ["id"])["fields"] == [{"name": "id", "type": "long"}]
    with pytest.raises(avro.SchemaError, match="no Avro type for time"):
        avro.from_columns("t", [pgtypes.PgColumn("x", 1083)])
    with pytest.raises(avro.SchemaError, match="type number 999 is not known"):
        avro.from_columns("t", [pgtypes.PgColumn("x", 999)])
    json.loads(avro.to_json(got))


def test_schema_registry():
    r = avro.Registry()
    one = avro.from_columns("t_payload", [pgtypes.PgColumn("id", 20)])
    two = avro.from_columns("t_payload", [pgtypes.PgColumn("id", 20), pgtypes.PgColumn("x", 25)])
    assert [r.register(s) for s in (one, one, two, one)] == [("t_payload", 1), ("t_payload", 1), ("t_payload", 2), ("t_payload", 1)]
