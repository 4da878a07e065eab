"""Media columns: Matroska files as binary values, written and parsed.

``packet_table`` walks the EBML elements of each file (variable-length ids and
sizes, sizes left unknown, nested masters), takes clusters apart into blocks,
undoes all four lacings and gives one row per frame with its track, timestamp
and byte range, plus the cues. ``mux`` stores a payload as unsigned 8-bit samples.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Element ids of the Matroska specification (RFC 9559).
EBML = 0x1A45DFA3
EBML_VERSION, EBML_READ_VERSION, EBML_MAX_ID, EBML_MAX_SIZE = 0x4286, 0x42F7, 0x42F2, 0x42F3
DOC_TYPE, DOC_TYPE_VERSION, DOC_TYPE_READ_VERSION = 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, DURATION = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489
MUXING_APP, WRITING_APP = 0x4D80, 0x5741
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86
FLAG_LACING, DEFAULT_DURATION, AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0x9C, 0x23E383, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, CLUSTER_TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, BLOCK_DURATION, REFERENCE_BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0x9B, 0xFB
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
#: Masters that the walk goes into; of these, those that may have no stated size, and what ends them.
_MASTERS = {SEGMENT, INFO, TRACKS, TRACK_ENTRY, AUDIO, CLUSTER, BLOCK_GROUP, CUES, CUE_POINT, CUE_TRACK_POSITIONS}
_TOP = {0x114D9B74, INFO, TRACKS, CLUSTER, CUES, 0x1941A469, 0x1043A770, 0x1254C367}
NO_LACE, XIPH, FIXED, EBML_LACE = 0, 1, 2, 3

PAD = 64
#: Samples a second, samples a frame, frames a block, blocks a cluster: 8 frames of 64 ms, clusters of about 16 s.
RATE, FRAME, LACE, BLOCKS = 8000, 512, 8, 32


class MediaError(ValueError):
    """The bytes are not a whole Matroska file."""


@dataclass
class Packet:
    track: int
    timestamp_ns: int
    offset: int
    size: int
    keyframe: bool
    lacing: int
    cluster: int
    block: int


@dataclass
class Media:
    timestamp_scale: int = 1_000_000
    duration: float | None = None
    tracks: list[dict] = field(default_factory=list)
    packets: list[Packet] = field(default_factory=list)
    clusters: list[int] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)  # time, track, cluster position in the segment
    segment_start: int = 0


def read_vint(data, at: int, marker: bool) -> tuple[int, int]:
    """(value, length) of a variable-length integer; with ``marker`` the length bits stay, as in ids. -1: unknown size."""
    if at >= len(data):
        raise MediaError(f"integer beyond the end at {at}")
    first = data[at]
    length = 9 - first.bit_length()
    if length > 8 or at + length > len(data):
        raise MediaError(f"bad integer at {at}")
    value = int.from_bytes(data[at : at + length], "big")
    if marker:
        return value, length
    mask = (1 << 7 * length) - 1
    value &= mask
    return (-1 if value == mask else value), length


def write_vint(value: int, length: int = 0) -> bytes:
    length = length or max(1, -(-(value + 1).bit_length() // 7))
    if value >= (1 << 7 * length) - 1:
        length += 1
    return (value | 1 << 7 * length).to_bytes(length, "big")


def element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + write_vint(len(body)) + body


def _uint(ident: int, value: int) -> bytes:
    return element(ident, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def _lace_sizes(data, at: int, end: int, kind: int) -> tuple[list[int], int]:
    """Sizes of the frames in a block and where the first one begins."""
    if kind == NO_LACE:
        return [end - at], at
    if at >= end:
        raise MediaError(f"lacing beyond the block at {at}")
    n, at = data[at] + 1, at + 1
    sizes: list[int] = []
    if kind == XIPH:
        for _ in range(n - 1):
            size = 0
            while True:
                if at >= end:
                    raise MediaError(f"lacing beyond the block at {at}")
                size, at, more = size + data[at], at + 1, data[at] == 255
                if not more:
                    break
            sizes.append(size)
    elif kind == EBML_LACE:
        for i in range(n - 1):
            value, length = read_vint(data, at, False)
            at += length
            # After the first size, differences with a bias that centres their range.
            sizes.append(value if not i else sizes[-1] + value - ((1 << 7 * length - 1) - 1))
    else:
        if (end - at) % n:
            raise MediaError(f"uneven fixed lacing at {at}")
        return [(end - at) // n] * n, at
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise MediaError(f"lacing beyond the block at {at}")
    return sizes, at


def parse(data: bytes) -> Media:
    """Takes a whole file apart. Raises MediaError on bytes that are no Matroska file or are cut short."""
    out = Media()
    if data[:4] != EBML.to_bytes(4, "big"):
        raise MediaError("no EBML header")
    size, length = read_vint(data, 4, False)
    if size < 0 or 4 + length + size >= len(data):
        raise MediaError("no segment")
    _elements(data, 4 + length + size, len(data), 0, out, {})
    return out


def _elements(data, at: int, end: int, parent: int, out: Media, state: dict) -> int:
    while at < end:
        ident, n = read_vint(data, at, True)
        if state.get("open") and ident in _TOP and parent == CLUSTER:
            return at  # a cluster without a stated size ends at the next top element
        size, m = read_vint(data, at + n, False)
        body = at + n + m
        unknown = size < 0
        stop = end if unknown else body + size
        if stop > end or unknown and ident not in (SEGMENT, CLUSTER):
            raise MediaError(f"element beyond its parent at {at}")
        if ident in _MASTERS:
            inner = state
            if ident == SEGMENT:
                out.segment_start = body
            elif ident == TRACK_ENTRY:
                out.tracks.append({"number": 0, "type": 0, "codec": "", "default_duration": 0, "rate": 8000.0, "channels": 1, "bit_depth": 0})
            elif ident == CLUSTER:
                out.clusters.append(at)
                inner = {"time": 0, "cluster": len(out.clusters) - 1, "block": 0, "open": unknown}
            elif ident == BLOCK_GROUP:
                inner = state | {"key": True, "first": len(out.packets)}
            elif ident == CUE_POINT:
                inner = {"cue_time": 0}
            elif ident == CUE_TRACK_POSITIONS:
                inner = state | {"cue_track": 0, "cue_at": 0}
            after = _elements(data, body, stop, ident, out, inner)
            if ident == BLOCK_GROUP:
                state["block"] = inner["block"]
                for p in out.packets[inner["first"] :]:
                    p.keyframe = inner["key"]
            elif ident == CUE_TRACK_POSITIONS:
                out.cues.append((state["cue_time"], inner["cue_track"], inner["cue_at"]))
            at = after if unknown else stop
            continue
        if ident in (SIMPLE_BLOCK, BLOCK):
            _block(data, body, stop, ident, out, state)
        elif parent in _MASTERS:
            _value(data, body, stop, ident, out, state)
        at = stop
    return at


def _value(data, at: int, end: int, ident: int, out: Media, state: dict) -> None:
    raw = data[at:end]
    number = int.from_bytes(raw, "big")
    track = out.tracks[-1] if out.tracks else {}
    if ident == CLUSTER_TIMESTAMP:
        state["time"] = number
    elif ident == TIMESTAMP_SCALE:
        out.timestamp_scale = number
    elif ident == REFERENCE_BLOCK:
        state["key"] = False
    elif ident == DURATION:
        out.duration = _float(raw)
    elif ident == SAMPLING_FREQUENCY:
        track["rate"] = _float(raw)
    elif ident == CODEC_ID:
        track["codec"] = bytes(raw).rstrip(b"\0").decode("ascii", "replace")
    elif ident in (TRACK_NUMBER, TRACK_TYPE, DEFAULT_DURATION, CHANNELS, BIT_DEPTH):
        name = {TRACK_NUMBER: "number", TRACK_TYPE: "type", DEFAULT_DURATION: "default_duration", CHANNELS: "channels", BIT_DEPTH: "bit_depth"}[ident]
        track[name] = number
    elif ident in (CUE_TIME, CUE_TRACK, CUE_CLUSTER_POSITION):
        state[{CUE_TIME: "cue_time", CUE_TRACK: "cue_track", CUE_CLUSTER_POSITION: "cue_at"}[ident]] = number


def _float(raw: bytes) -> float:
    import struct

    return struct.unpack(">f" if len(raw) == 4 else ">d", raw)[0] if raw else 0.0


def _block(data, at: int, end: int, ident: int, out: Media, state: dict) -> None:
    number, n = read_vint(data, at, False)
    if at + n + 3 > end:
        raise MediaError(f"short block at {at}")
    relative = int.from_bytes(data[at + n : at + n + 2], "big", signed=True)
    flags = data[at + n + 2]
    kind = flags >> 1 & 3
    sizes, at = _lace_sizes(data, at + n + 3, end, kind)
    track = next((t for t in out.tracks if t["number"] == number), {})
    time = (state["time"] + relative) * out.timestamp_scale
    for i, size in enumerate(sizes):
        out.packets.append(Packet(number, time + i * track.get("default_duration", 0), at, size, bool(flags & 0x80), kind, state["cluster"], state["block"]))
        at += size
    state["block"] += 1


def _laced(frames: list[bytes], kind: int) -> bytes:
    head = bytes([len(frames) - 1]) if kind else b""
    sizes = [len(f) for f in frames]
    if kind == XIPH:
        for s in sizes[:-1]:
            head += b"\xff" * (s // 255) + bytes([s % 255])
    elif kind == EBML_LACE:
        head += write_vint(sizes[0])
        for a, b in zip(sizes[:-2], sizes[1:-1], strict=True):
            n = next(n for n in range(1, 9) if abs(b - a) < (1 << 7 * n - 1) - 1)
            head += write_vint(b - a + (1 << 7 * n - 1) - 1, n)
    return head + b"".join(frames)


def mux(payload: bytes, lacings: tuple[int, ...] = (FIXED, EBML_LACE, XIPH)) -> bytes:
    """A file with the payload as mono unsigned 8-bit samples on track 1, clusters with cues.

    Equal payloads give equal bytes. Whole blocks take the lacings in turn; a
    lone frame is not laced, and a shorter last frame rules out fixed lacing.
    """
    import struct

    frames = [payload[i : i + FRAME] for i in range(0, len(payload), FRAME)]
    ms = FRAME * 1000 // RATE
    clusters, cues, position = [], [], 0
    info = element(
        INFO,
        _uint(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", len(payload) * 1000 / RATE)) + element(MUXING_APP, b"tidelog") + element(WRITING_APP, b"tidelog"),
    )
    audio = element(SAMPLING_FREQUENCY, struct.pack(">d", RATE)) + _uint(CHANNELS, 1) + _uint(BIT_DEPTH, 8)
    entry = _uint(TRACK_NUMBER, 1) + _uint(TRACK_UID, 1) + _uint(TRACK_TYPE, 2) + _uint(FLAG_LACING, 1) + _uint(DEFAULT_DURATION, ms * 1_000_000)
    tracks = element(TRACKS, element(TRACK_ENTRY, entry + element(CODEC_ID, b"A_PCM/INT/LIT") + element(AUDIO, audio)))
    position = len(info) + len(tracks)
    for c in range(0, len(frames), LACE * BLOCKS):
        blocks = []
        for i, b in enumerate(range(c, min(c + LACE * BLOCKS, len(frames)), LACE)):
            group = frames[b : b + LACE]
            kind = lacings[i % len(lacings)] if len(group) > 1 else NO_LACE
            if kind == FIXED and len({len(f) for f in group}) > 1:
                kind = EBML_LACE
            body = write_vint(1) + struct.pack(">h", (b - c) * ms) + bytes([0x80 | kind << 1]) + _laced(group, kind)
            blocks.append(element(SIMPLE_BLOCK, body))
        cues.append(element(CUE_POINT, _uint(CUE_TIME, c * ms) + element(CUE_TRACK_POSITIONS, _uint(CUE_TRACK, 1) + _uint(CUE_CLUSTER_POSITION, position))))
        clusters.append(element(CLUSTER, _uint(CLUSTER_TIMESTAMP, c * ms) + b"".join(blocks)))
        position += len(clusters[-1])
    head = element(
        EBML,
        _uint(EBML_VERSION, 1) + _uint(EBML_READ_VERSION, 1) + _uint(EBML_MAX_ID, 4) + _uint(EBML_MAX_SIZE, 8)
        + element(DOC_TYPE, b"matroska") + _uint(DOC_TYPE_VERSION, 4) + _uint(DOC_TYPE_READ_VERSION, 2),
    )
    return head + element(SEGMENT, info + tracks + b"".join(clusters) + element(CUES, b"".join(cues)))


def payload_of(text: str | None) -> tuple[bytes, int]:
    """(UTF-8 with zero bytes up to a positive multiple of 64, length before)."""
    raw = (text or "").encode("utf-8")
    return raw + b"\0" * (-len(raw) % PAD if raw else PAD), len(raw)


def samples(data: bytes, media: Media, track: int = 1) -> bytes:
    return b"".join([data[p.offset : p.offset + p.size] for p in media.packets if p.track == track])


def feature(data: bytes, media: Media, read: bytes) -> str:
    """Packet-table and sample features: equal files, equal strings."""
    import numpy as np

    s = np.frombuffer(read, dtype=np.uint8)
    centred = s.astype(np.int16) - 128
    crossings = int(np.count_nonzero((centred[1:] < 0) != (centred[:-1] < 0)))
    energy = int((centred.astype(np.int64) ** 2).sum())
    shown = {
        "packets": len(media.packets), "clusters": len(media.clusters), "cues": len(media.cues), "lacings": "".join(map(str, sorted({p.lacing for p in media.packets}))),
        "last_ns": media.packets[-1].timestamp_ns, "sum": int(s.sum()), "energy": energy, "crossings": crossings,
    }
    return ";".join(f"{k}={v}" for k, v in shown.items())


_PACKET = T.StructType(
    [T.StructField("track", T.LongType()), T.StructField("timestamp_ns", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("size", T.LongType()),
     T.StructField("keyframe", T.BooleanType()), T.StructField("lacing", T.IntegerType()), T.StructField("cluster", T.IntegerType()), T.StructField("block", T.IntegerType())]
)
_PARSED = T.StructType(
    [T.StructField("packets", T.ArrayType(_PACKET)),
     T.StructField("cues", T.ArrayType(T.StructType([T.StructField("time", T.LongType()), T.StructField("track", T.LongType()), T.StructField("cluster_offset", T.LongType())]))),
     T.StructField("error", T.StringType())]
)


def parse_column(df: DataFrame, media: str, into: str = "parsed") -> DataFrame:
    """Adds ``into``: packets (one struct a frame), cues and error for each binary value.

    Null values give null; bytes that are no whole file give no packets and the
    error's text. Other columns stay.
    """
    schema = T.StructType([f for f in df.schema.fields if f.name != into] + [T.StructField(into, _PARSED)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        for b in batches:
            found = []
            for v in b.column(b.schema.get_field_index(media)).to_pylist():
                if v is None:
                    found.append(None)
                    continue
                try:
                    m = parse(v)
                    found.append({
                        "packets": [vars(p) for p in m.packets],
                        "cues": [{"time": t, "track": k, "cluster_offset": m.segment_start + at} for t, k, at in m.cues], "error": None,
                    })
                except MediaError as e:
                    found.append({"packets": [], "cues": [], "error": str(e)})
            kind = kind or _arrow(_PARSED)
            columns = [b.column(b.schema.get_field_index(f.name)) for f in schema.fields[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def packet_table(df: DataFrame, media: str, keys: list[str]) -> DataFrame:
    """One row per frame: the keys, track, timestamp, byte range, keyframe, lacing, cluster and block."""
    from pyspark.sql import functions as F

    return parse_column(df.select(*keys, media), media, "parsed_").select(*keys, F.inline("parsed_.packets"))


def media_features(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Stores each whole text as media, reads the stored bytes back and describes both.

    (key, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature); nulls are empty texts. One text is in memory at a time
    beside its Arrow batch.
    """
    long, string = T.LongType(), T.StringType()
    kinds = [("n_bytes", long), ("payload_bytes", long), ("payload_sha256", string), ("tail_crc32", long), ("media_bytes", long), ("media_sha256", string), ("feature", string)]
    schema = T.StructType([docs.schema[key]] + [T.StructField(n, k) for n, k in kinds])

    def describe(value: str | None) -> tuple:
        payload, n = payload_of(value)
        stored = mux(payload)
        del payload
        m = parse(stored)
        read = samples(stored, m)
        return (
            n, len(read), hashlib.sha256(read).hexdigest(), zlib.crc32(read[-PAD:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(stored, m, read),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [describe(v.as_py()) for v in b.column(1)]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            arrays = [pa.array(c, pa.int64() if k is long else pa.string()) for c, (_, k) in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], names=[f.name for f in schema.fields])

    return docs.select(key, text).mapInArrow(run, schema)
