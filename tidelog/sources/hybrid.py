"""A stream that first gives a snapshot of tables and then their changes, without a gap.

The offset is the pipeline's position: while the snapshot lasts, how far each table
has come; after it, the last log sequence number. The feed's position is taken
before the snapshot's bounds: changes up to it are in the snapshot already and don't
come again; a change made during the snapshot comes after it, and applying it
twice has no effect on keyed tables.

Options: ``snapshot.<table>`` (Parquet path), or ``url`` (a folder) and ``tables`` (names
in it, ``*``: all); ``key.<table>``; ``changes`` (Parquet path of a change log with lsn, kind,
relation, key, payload, and seq where several changes share an lsn);
``snapshot.fetchSize``, ``batch.size`` (most keys, or log sequence numbers, in a
micro-batch; 0: all there are), ``snapshotMode``, ``snapshot.includeNonpositiveKeys``,
``startLsn`` (where the feed begins, if not at its end) and ``startPosition``. Partitions
are key ranges; each reads its own part of the files on an executor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..functions.position import Position, PositionType, Progress, SnapshotPosition, format_lsn, parse_lsn, parse_position
from .options import ALL_TABLES, FETCH_SIZE, OptionsError, SourceOptions, option

SCHEMA = "collection string, operation string, lsn bigint, position string, key bigint, payload string, seq bigint"
#: Partitions of a micro-batch at most; ranges grow beyond the fetch size for that.
PARTITIONS = 10_000
_TYPES = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
# Kinds of rows in a change log and the operations they become; begin and commit frame transactions, others are ignored.
_KINDS = {"insert": "create", "update": "update", "delete": "delete"}


class FeedError(ValueError):
    """The change log contradicts itself."""


@dataclass
class Range(InputPartition):
    """Rows of a table, or of the change log (no table), with ``low`` < key <= ``high``; no ``low``: from the first."""

    table: str
    path: str
    key: str
    low: int | None
    high: int
    end: int


def _dataset(path: str):
    import pyarrow.dataset as ds

    return ds.dataset(path, format="parquet")


def _edge(path: str, column: str, least: bool = False, seen: dict[str, int | None] | None = None) -> int | None:
    """The greatest (or least) value of a column, from the files' footers; files without statistics are read.

    ``seen`` remembers what files have said: files of a log don't change.
    """
    found = []
    for f in _dataset(path).get_fragments():
        if seen is not None and f.path in seen:
            found.append(seen[f.path])
            continue
        own, known = [], True
        for g in f.row_groups:
            stats = (g.statistics or {}).get(column)
            known &= stats is not None or not g.num_rows
            if stats is not None:
                own.append(stats["min" if least else "max"])
        if not known:
            own = [pc.min(b.column(0)).as_py() if least else pc.max(b.column(0)).as_py() for b in f.to_batches(columns=[column]) if b.num_rows]
        own = [x for x in own if x is not None]
        value = (min(own) if least else max(own)) if own else None
        if seen is not None:
            seen[f.path] = value
        found.append(value)
    found = [x for x in found if x is not None]
    return (min(found) if least else max(found)) if found else None


def _tables_in(folder: str, wanted: list[str]) -> dict[str, str]:
    """Paths of tables, each a Parquet file or folder of its name, in a folder."""
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
    there = {i.base_name.removesuffix(".parquet"): i.base_name for i in store.get_file_info(fs.FileSelector(inner)) if not i.base_name.startswith(("_", "."))}
    names = sorted(there) if wanted == [ALL_TABLES] else wanted
    missing = [f'table "{t}" does not exist' for t in names if t not in there]
    if missing:
        raise OptionsError("\n".join(missing))
    return {t: f"{folder.rstrip('/')}/{there[t]}" for t in names}


class HybridReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.tables = {k.split(".", 1)[1]: v for k, v in options.items() if k.lower().startswith("snapshot.") and k.lower() not in ("snapshot.fetchsize", "snapshot.includenonpositivekeys")}
        if option(options, "tables"):
            given = SourceOptions.parse({"url": option(options, "url") or "", "tables": option(options, "tables") or ""} | self._known())
            self.tables = _tables_in(given.url, given.tables) | self.tables
        else:  # tables by their own paths: the rest of the options must be right all the same
            given = SourceOptions.parse({"url": "file:/", "tables": ",".join(self.tables) or "none"} | self._known())
        self.keys = {k.split(".", 1)[1]: v for k, v in options.items() if k.lower().startswith("key.")}
        missing = [f'missing key for table "{t}"' for t in self.tables if t not in self.keys]
        if missing:
            raise OptionsError("\n".join(missing))
        self.changes = option(options, "changes") or ""
        self.fetch = given.fetch_size or FETCH_SIZE
        self.batch = given.batch_size
        self.never = given.snapshot_mode == "never"
        self.from_first = given.include_nonpositive_keys
        self.progress = Progress()
        self.seen: dict[str, int | None] = {}

    def _known(self) -> dict[str, str]:
        """Options that ``SourceOptions`` checks, under their public names; short names of two are taken as well."""
        names = ("snapshotMode", "snapshot.fetchSize", "cdcMode", "logrepl.publicationName", "logrepl.slotName", "logrepl.autoCleanup", "snapshot.includeNonpositiveKeys", "batch.size", "batch.delay")
        out = {n: option(self.options, n) for n in names}
        out["snapshot.fetchSize"] = out["snapshot.fetchSize"] or option(self.options, "fetchSize")
        out["batch.size"] = out["batch.size"] or option(self.options, "batchSize")
        return {k: v for k, v in out.items() if v is not None}

    # Offsets are positions; Spark stores them as JSON.

    def initialOffset(self) -> dict:
        given = parse_position(option(self.options, "startPosition") or "")
        if given.type != PositionType.INITIAL:
            return _offset(given)
        # The feed's position comes first: what changes from here on is not lost, whatever the snapshot sees of it.
        start = option(self.options, "startLsn")
        lsn = format_lsn(parse_lsn(start) if start else self._top(0))
        if self.never or not self.tables:
            return _offset(Position(PositionType.CDC, None, lsn))
        ends = {}
        for t, p in self.tables.items():
            first = 0
            if self.from_first:
                first = min(0, (_edge(p, self.keys[t], least=True) or 0) - 1)
            ends[t] = SnapshotPosition(first, max(first, _edge(p, self.keys[t]) or 0))
        return _offset(Position(PositionType.SNAPSHOT, ends, lsn))

    def _top(self, last: int) -> int:
        """The feed's greatest position, from footers; files seen before are not opened again."""
        return max(last, _edge(self.changes, "lsn", seen=self.seen) or 0) if self.changes else last

    def latestOffset(self) -> dict:
        """The end of the snapshot, then of the feed; a batch has rows of one phase."""
        current = getattr(self, "current", None) or self.initialOffset()
        p = parse_position(current["position"])
        if p.type == PositionType.SNAPSHOT and any(s.last_read < s.snapshot_end for s in (p.snapshots or {}).values()):
            left, new = self.batch or None, {}
            for t, s in p.snapshots.items():
                step = s.snapshot_end - s.last_read if left is None else min(left, s.snapshot_end - s.last_read)
                new[t] = SnapshotPosition(s.last_read + step, s.snapshot_end)
                left = None if left is None else left - step
            self.current = _offset(Position(PositionType.SNAPSHOT, new, p.last_lsn))
            return self.current
        last = parse_lsn(p.last_lsn)
        top = self._top(last)
        if self.batch > 0:
            top = min(top, last + self.batch)
        if top == last:
            return current
        self.current = _offset(Position(PositionType.CDC, None, format_lsn(top)))
        return self.current

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        a, z = parse_position(start["position"]), parse_position(end["position"])
        self.current = end
        out: list[InputPartition] = []
        if z.type == PositionType.SNAPSHOT:
            before = a.snapshots or {}
            for t, s in z.snapshots.items():
                low = before.get(t, SnapshotPosition()).last_read
                out += [Range(t, self.tables[t], self.keys[t], i, j, s.snapshot_end) for i, j in self._ranges(low, s.last_read)]
            return out
        low, high = parse_lsn(a.last_lsn), parse_lsn(z.last_lsn)
        return [Range("", self.changes, "lsn", i, j, high) for i, j in self._ranges(low, high)]

    def _ranges(self, low: int, high: int) -> list[tuple[int, int]]:
        step = max(self.fetch, -(-(high - low) // PARTITIONS))
        return [(i, min(i + step, high)) for i in range(low, high, step)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        p = partition
        where = (ds.field(p.key) > p.low) & (ds.field(p.key) <= p.high)
        data = _dataset(p.path)
        if p.table:
            for b in data.to_batches(filter=where):
                if b.num_rows:
                    yield _snapshot_batch(p, b.sort_by(p.key))
            return
        names = ["lsn", "kind", "relation", "key", "payload", *(["seq"] if "seq" in data.schema.names else [])]
        marks = [b for b in data.to_batches(columns=["lsn", "kind"], filter=where & ds.field("kind").isin(["begin", "commit"])) if b.num_rows]
        _check_commits(marks)
        for b in data.to_batches(columns=names, filter=where & ds.field("kind").isin(list(_KINDS))):
            if b.num_rows:
                yield _change_batch(b)

    def commit(self, end: dict) -> None:
        """The end of a batch that has been applied: the feed up to here is confirmed."""
        if parse_position(end["position"]).type == PositionType.CDC and parse_position(end["position"]).lsn():
            self.progress.ack(end["position"])


def _snapshot_batch(p: Range, rows: pa.RecordBatch) -> pa.RecordBatch:
    import base64
    import json

    def plain(v):
        return base64.b64encode(v).decode() if isinstance(v, bytes) else str(v)  # as from_json reads binary columns

    n, keys = rows.num_rows, rows.column(rows.schema.get_field_index(p.key)).cast(pa.int64())
    places = [Position(PositionType.SNAPSHOT, {p.table: SnapshotPosition(k, p.end)}).to_json() for k in keys.to_pylist()]
    payload = [json.dumps(r, default=plain, ensure_ascii=False) for r in rows.to_pylist()]
    values = [[p.table] * n, ["snapshot"] * n, pa.nulls(n, pa.int64()), places, keys, payload, pa.nulls(n, pa.int64())]
    return _batch(values)


def _change_batch(rows: pa.RecordBatch) -> pa.RecordBatch:
    column = lambda name: rows.column(rows.schema.get_field_index(name))
    if column("relation").null_count:
        raise FeedError("a change names no relation")
    kinds = column("kind").cast(pa.string())
    operations = pa.array(list(_KINDS.values())).take(pc.index_in(kinds, pa.array(list(_KINDS))))
    lsn = column("lsn").cast(pa.int64())
    places = [Position(PositionType.CDC, None, format_lsn(x)).to_json() for x in lsn.to_pylist()]
    seq = column("seq").cast(pa.int64()) if "seq" in rows.schema.names else pa.nulls(rows.num_rows, pa.int64())
    return _batch([column("relation"), operations, lsn, places, column("key"), column("payload"), seq])


def _batch(values: list) -> pa.RecordBatch:
    arrays = [v.cast(t) if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values, _TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def _check_commits(marks: list[pa.RecordBatch]) -> None:
    """A transaction begins with the position that it commits at, so in a log with such rows each commit meets its begin."""
    seen: dict[str, set] = {"begin": set(), "commit": set()}
    for b in marks:
        for lsn, kind in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            seen[kind].add(lsn)
    wrong = sorted(seen["commit"] - seen["begin"])
    if wrong:
        raise FeedError(f"no transaction has announced the commit at {format_lsn(wrong[0])}")


def _offset(p: Position) -> dict:
    return {"position": p.to_json()}


class HybridSource(DataSource):
    """``spark.dataSource.register(HybridSource)``, then ``readStream.format("tidelog")``."""

    @classmethod
    def name(cls) -> str:
        return "tidelog"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return HybridReader(dict(self.options))
