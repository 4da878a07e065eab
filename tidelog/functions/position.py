"""Positions of a pipeline and log sequence numbers, as values and as columns."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from enum import IntEnum

from pyspark.sql import Column
from pyspark.sql import functions as F


class PositionType(IntEnum):
    INITIAL = 0
    SNAPSHOT = 1
    CDC = 2


# Names as they appear in error messages.
_TYPE_NAMES = {0: "Initial", 1: "Snapshot", 2: "CDC"}


def type_name(value: int) -> str:
    return _TYPE_NAMES.get(int(value), f"Type({int(value)})")


class PositionError(ValueError):
    pass


@dataclass
class SnapshotPosition:
    last_read: int = 0
    snapshot_end: int = 0


@dataclass
class Position:
    """``type``, per table how far a snapshot has come, and the last log sequence number."""

    type: int = PositionType.INITIAL
    snapshots: dict[str, SnapshotPosition] | None = None
    last_lsn: str = ""

    def to_json(self) -> str:
        out: dict = {"type": int(self.type)}
        if self.snapshots:
            out["snapshots"] = {t: {"last_read": s.last_read, "snapshot_end": s.snapshot_end} for t, s in sorted(self.snapshots.items())}
        if self.last_lsn:
            out["last_lsn"] = self.last_lsn
        return json.dumps(out, separators=(",", ":"), ensure_ascii=False)

    def lsn(self) -> int:
        return parse_lsn(self.last_lsn)


def parse_position(text: str | bytes | None) -> Position:
    """Empty text is the initial position."""
    if not text:
        return Position()
    raw = text.decode() if isinstance(text, bytes) else text
    try:
        value = json.loads(raw)
    except ValueError as e:
        ended = getattr(e, "pos", 0) >= len(raw.rstrip())
        raise PositionError(f"invalid position: {'unexpected end of JSON input' if ended else e}") from e
    if not isinstance(value, dict):
        raise PositionError("invalid position: not an object")
    found = value.get("snapshots")
    snapshots = {t: SnapshotPosition(int(s.get("last_read", 0)), int(s.get("snapshot_end", 0))) for t, s in found.items()} if found else None
    return Position(int(value.get("type", 0)), snapshots, value.get("last_lsn", "") or "")


def parse_lsn(text: str) -> int:
    """``HI/LO`` in hexadecimal; empty is 0."""
    if not text:
        return 0
    high, slash, low = text.partition("/")
    try:
        if not slash:
            raise ValueError
        a, b = int(high, 16), int(low, 16)
        if not (0 <= a < 1 << 32 and 0 <= b < 1 << 32):
            raise ValueError
    except ValueError:
        raise PositionError("failed to parse LSN: expected integer") from None
    return a << 32 | b


def format_lsn(value: int) -> str:
    return f"{value >> 32:X}/{value & 0xFFFFFFFF:X}"


def lsn_text(lsn: Column) -> Column:
    """A bigint as ``HI/LO``."""
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(lsn.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))))


def lsn_value(text: Column) -> Column:
    """``HI/LO`` as a bigint; null and empty are 0."""
    part = lambda i: F.conv(F.split_part(text, F.lit("/"), F.lit(i)), 16, 10).cast("bigint")
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0).cast("bigint")).otherwise(F.shiftleft(part(1), 32).bitwiseOR(part(2)))


def snapshot_position(table: str, last_read: Column, snapshot_end: Column) -> Column:
    """JSON of a position inside the snapshot of one table."""
    one = F.struct(last_read.cast("bigint").alias("last_read"), snapshot_end.cast("bigint").alias("snapshot_end"))
    return F.to_json(F.struct(F.lit(int(PositionType.SNAPSHOT)).alias("type"), F.create_map(F.lit(table), one).alias("snapshots")))


def cdc_position(lsn: Column) -> Column:
    return F.to_json(F.struct(F.lit(int(PositionType.CDC)).alias("type"), lsn_text(lsn).alias("last_lsn")))


def validate_ack(position: str | bytes) -> int:
    """Log sequence number that an acknowledged position confirms."""
    p = parse_position(position)
    if p.type != PositionType.CDC:
        raise PositionError(f'invalid type "{type_name(p.type)}" for CDC position')
    value = p.lsn()
    if value == 0:
        raise PositionError("cannot ack zero position")
    return value


def start_lsn(start: Column, restart: Column) -> Column:
    """Where replication begins: never before the oldest position that is still kept."""
    return F.when((start == 0) | (start < restart), restart).otherwise(start)


def standby_status(written: Column, flushed: Column, server_end: Column) -> Column:
    """What a progress report does: an error if more is flushed than written; the server's end if all is."""
    caught_up = (flushed == written) & (flushed < server_end)
    return F.when(flushed > written, "error").when(caught_up, "send_wal_end").otherwise("send_flushed")


@dataclass
class Progress:
    """The values of a running feed's progress reports."""

    written: int = 0
    flushed: int = 0
    server_end: int = 0
    restart: int = 0
    history: list[int] = field(default_factory=list)

    def ack(self, position: str) -> None:
        self.flushed = validate_ack(position)  # the last one counts, even if it is smaller

    def report(self) -> int:
        if self.flushed > self.written:
            raise PositionError(f"last flushed LSN {format_lsn(self.flushed)} is beyond the last written {format_lsn(self.written)}")
        value = self.server_end if self.flushed == self.written and self.flushed < self.server_end else self.flushed
        self.history.append(value)
        return value
