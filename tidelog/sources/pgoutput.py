"""Decoder of logical replication messages (pgoutput, protocol version 1) to change rows.

Messages come as rows (seq, data) in feed order. Row messages name their relation by
number, and what a number stands for is said by relation messages earlier in the
feed; so relations are read first (they are few), and all row messages decode in
parallel after that.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.pgtypes import PgColumn, decode_text
from ..operators.asof import as_of

#: Kinds of messages by their first byte; the rest of the feed is ignored.
KINDS = {b"B": "begin", b"C": "commit", b"R": "relation", b"I": "insert", b"U": "update", b"D": "delete"}


class FeedError(ValueError):
    pass


@dataclass
class Relation:
    id: int
    namespace: str
    name: str
    columns: list[PgColumn]


@dataclass
class Message:
    kind: str
    lsn: int = 0
    relation: int = 0
    old: list[str | None] | None = None
    new: list[str | None] | None = None
    unchanged: list[int] = field(default_factory=list)
    definition: Relation | None = None


def _text(data: bytes, at: int) -> tuple[str, int]:
    end = data.index(b"\0", at)
    return data[at:end].decode(), end + 1


def _tuple(data: bytes, at: int) -> tuple[list[str | None], list[int], int]:
    """(values, positions of columns that the feed left out, end)."""
    (n,) = struct.unpack_from(">H", data, at)
    at += 2
    values: list[str | None] = []
    unchanged: list[int] = []
    for i in range(n):
        kind = data[at : at + 1]
        at += 1
        if kind == b"t":
            (size,) = struct.unpack_from(">I", data, at)
            values.append(data[at + 4 : at + 4 + size].decode())
            at += 4 + size
        elif kind in (b"n", b"u"):
            values.append(None)
            if kind == b"u":
                unchanged.append(i)
        else:
            raise FeedError(f"unknown column kind {kind!r}")
    return values, unchanged, at


def decode(data: bytes) -> Message | None:
    """One message; None for kinds that carry no change."""
    kind = KINDS.get(data[:1])
    try:
        if kind == "begin":
            return Message(kind, struct.unpack_from(">Q", data, 1)[0])
        if kind == "commit":
            return Message(kind, struct.unpack_from(">Q", data, 2)[0])
        if kind == "relation":
            (ident,) = struct.unpack_from(">I", data, 1)
            namespace, at = _text(data, 5)
            name, at = _text(data, at)
            (n,) = struct.unpack_from(">H", data, at + 1)
            at += 3
            columns = []
            for _ in range(n):
                flags = data[at]
                column, at = _text(data, at + 1)
                oid, typmod = struct.unpack_from(">Ii", data, at)
                at += 8
                columns.append(PgColumn(column, oid, typmod, bool(flags & 1)))
            return Message(kind, relation=ident, definition=Relation(ident, namespace, name, columns))
        if kind in ("insert", "update", "delete"):
            (ident,) = struct.unpack_from(">I", data, 1)
            out = Message(kind, relation=ident)
            at = 5
            while at < len(data):
                part = data[at : at + 1]
                values, unchanged, at = _tuple(data, at + 1)
                if part == b"N":
                    out.new, out.unchanged = values, unchanged
                else:  # K: the old key, O: the whole old row
                    out.old = values
            return out
    except (struct.error, IndexError, ValueError) as e:
        raise FeedError(f"broken {kind} message: {e}") from e
    return None


_SHAPE = (
    "seq long, kind string, lsn long, relation_id long, old array<string>, new array<string>, unchanged array<int>, "
    "relation string, columns array<struct<name:string,oid:long,typmod:int,key:boolean>>"
)


def decoded(messages: DataFrame) -> DataFrame:
    """Every message taken apart: one row each, ignored kinds left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [p.split(" ")[0] for p in _SHAPE.split(", ")]
        column = pa.struct([("name", pa.string()), ("oid", pa.int64()), ("typmod", pa.int32()), ("key", pa.bool_())])
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.string(), pa.list_(column)]
        for b in batches:
            rows = []
            for seq, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                m = decode(data) if data else None
                if m is None:
                    continue
                d = m.definition
                own = [{"name": c.name, "oid": c.oid, "typmod": c.typmod, "key": c.key} for c in d.columns] if d else None
                lsn = m.lsn - (1 << 64) if m.lsn >= 1 << 63 else m.lsn
                rows.append((seq, m.kind, lsn, m.relation, m.old, m.new, m.unchanged, d.name if d else None, own))
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return messages.select("seq", "data").mapInArrow(run, _SHAPE)


def with_context(rows: DataFrame) -> DataFrame:
    """Row messages with the relation valid at their place, and their transaction's position as ``lsn``."""
    known = as_of(rows, ["relation_id"], F.col("kind") == "relation", F.struct("relation", "columns"), "definition_")
    known = as_of(known, [], F.col("kind") == "begin", F.col("lsn"), "tx_lsn_")
    changes = known.where(F.col("kind").isin("insert", "update", "delete"))
    return changes.select(
        "seq", "kind", F.coalesce("tx_lsn_", "lsn").alias("lsn"), "relation_id",
        F.col("definition_.relation").alias("relation"), F.col("definition_.columns").alias("columns"), "old", "new", "unchanged",
    )


def unknown_relations(rows: DataFrame) -> DataFrame:
    """Relation numbers of changes that no relation message explains: an error of the feed."""
    return rows.where("relation is null").select("relation_id").distinct()


def typed(rows: DataFrame, relation: str, columns: list[PgColumn], feed_columns: list[str] | None = None) -> DataFrame:
    """Change rows of one relation with typed images: lsn, seq, kind, relation, old, new, unchanged (names).

    ``feed_columns``: the columns in the order of the feed, if it differs. Columns
    that a feed does not carry are null.
    """
    order = feed_columns or [c.name for c in columns]

    def image(name: str) -> Column:
        fields = []
        for c in columns:
            text = F.try_element_at(F.col(name), F.lit(order.index(c.name) + 1)) if c.name in order else F.lit(None).cast("string")
            fields.append(decode_text(text, c.oid, c.typmod).alias(c.name))
        return F.when(F.col(name).isNotNull(), F.struct(*fields)).alias(name)

    names = F.array(*[F.lit(n) for n in order])
    left_out = F.transform(F.coalesce("unchanged", F.array().cast("array<int>")), lambda i: F.element_at(names, i + 1))
    return rows.where(F.col("relation") == relation).select("lsn", "seq", "kind", "relation", image("old"), image("new"), left_out.alias("unchanged"))


# Writing messages: for tests, and for feeds recorded from other sources.


def encode_begin(lsn: int, xid: int = 1) -> bytes:
    return b"B" + struct.pack(">QqI", lsn, 0, xid)


def encode_commit(lsn: int) -> bytes:
    return b"C\0" + struct.pack(">QQq", lsn, lsn + 8, 0)


def encode_relation(r: Relation) -> bytes:
    out = b"R" + struct.pack(">I", r.id) + r.namespace.encode() + b"\0" + r.name.encode() + b"\0d" + struct.pack(">H", len(r.columns))
    for c in r.columns:
        out += bytes([c.key]) + c.name.encode() + b"\0" + struct.pack(">Ii", c.oid, c.typmod)
    return out


def encode_tuple(values: list[str | None], unchanged: tuple[int, ...] = ()) -> bytes:
    out = struct.pack(">H", len(values))
    for i, v in enumerate(values):
        out += b"u" if i in unchanged else b"n" if v is None else b"t" + struct.pack(">I", len(v.encode())) + v.encode()
    return out


def encode_row(kind: str, relation: int, new: list | None = None, old: list | None = None, full: bool = False, unchanged: tuple[int, ...] = ()) -> bytes:
    out = {"insert": b"I", "update": b"U", "delete": b"D"}[kind] + struct.pack(">I", relation)
    if old is not None:
        out += (b"O" if full else b"K") + encode_tuple(old)
    if new is not None:
        out += b"N" + encode_tuple(new, unchanged)
    return out
