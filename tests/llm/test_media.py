import hashlib
import random
import zlib

import pytest

from tidelog.llm import matroska as m


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 512, 513, 4096, 4160, 4096 * 32, 4096 * 32 + 70])
def test_round_trip(n):
    r = random.Random(n)
    payload, size = m.payload_of("".join(chr(r.randint(32, 126)) for _ in range(n)))
    assert size == n and len(payload) % 64 == 0 and payload
    stored = m.mux(payload)
    media = m.parse(stored)
    assert m.samples(stored, media) == payload
    assert all(media.segment_start + at in media.clusters for _, _, at in media.cues) and len(media.cues) == len(media.clusters)
    times = [p.timestamp_ns for p in media.packets]
    assert times == [i * 64_000_000 for i in range(len(times))]


@pytest.mark.parametrize("kind", [m.NO_LACE, m.XIPH, m.FIXED, m.EBML_LACE])
def test_lacings(kind):
    sizes = {m.NO_LACE: [700], m.XIPH: [0, 255, 254, 600, 3], m.FIXED: [40] * 5, m.EBML_LACE: [800, 500, 1300, 2, 9]}[kind]
    frames = [bytes([i]) * s for i, s in enumerate(sizes)]
    data = m._laced(frames, kind)
    got, at = m._lace_sizes(data, 0, len(data), kind)
    assert got == sizes
    for f, s in zip(frames, got, strict=True):
        assert data[at : at + s] == f
        at += s


def test_vints():
    for value in (0, 1, 126, 127, 128, 16382, 16383, 2**28, 2**49):
        raw = m.write_vint(value)
        assert m.read_vint(raw, 0, False) == (value, len(raw))
    assert m.read_vint(b"\xff", 0, False) == (-1, 1)


def _file(*clusters: bytes, tracks: bytes = b"") -> bytes:
    head = m.element(m.EBML, m.element(m.DOC_TYPE, b"matroska"))
    return head + bytes.fromhex("18538067") + b"\x01" + b"\xff" * 7 + tracks + b"".join(clusters)


def test_unknown_sizes_block_groups_and_tracks():
    tracks = m.element(m.TRACKS, m.element(m.TRACK_ENTRY, m._uint(m.TRACK_NUMBER, 1)) + m.element(m.TRACK_ENTRY, m._uint(m.TRACK_NUMBER, 2) + m._uint(m.DEFAULT_DURATION, 5_000_000)))
    open_cluster = bytes.fromhex("1F43B675") + b"\xff" + m._uint(m.CLUSTER_TIMESTAMP, 7) + m.element(m.SIMPLE_BLOCK, b"\x81\xff\xfe\x80abc")
    group = m.element(m.BLOCK_GROUP, m.element(m.BLOCK, b"\x82\0\x01\x04" + m._laced([b"xx", b"yy"], m.FIXED)) + m._uint(m.REFERENCE_BLOCK, 1))
    second = m.element(m.CLUSTER, m._uint(m.CLUSTER_TIMESTAMP, 100) + group)
    data = _file(open_cluster, second, tracks=tracks)
    media = m.parse(data)
    shown = [(p.track, p.timestamp_ns, data[p.offset : p.offset + p.size], p.keyframe, p.cluster) for p in media.packets]
    assert shown == [(1, 5_000_000, b"abc", True, 0), (2, 101_000_000, b"xx", False, 1), (2, 106_000_000, b"yy", False, 1)]


def test_broken_files():
    whole = m.mux(b"x" * 6400)
    for cut in (0, 3, 5, 40, 100, len(whole) - 1):
        with pytest.raises(m.MediaError):
            m.parse(whole[:cut])


def test_features(docs, none):
    rows = {r.doc_id: r for r in m.media_features(docs.where("doc_id is not null")).collect()}
    for r in docs.where("doc_id is not null").collect():
        raw = (r.text or "").encode()
        padded = raw + b"\0" * (-len(raw) % 64 if raw else 64)
        got = rows[r.doc_id]
        assert (got.n_bytes, got.payload_bytes) == (len(raw), len(padded))
        assert got.payload_sha256 == hashlib.sha256(padded).hexdigest() and got.tail_crc32 == zlib.crc32(padded[-64:])
        stored = m.mux(padded)
        assert got.media_bytes == len(stored) and got.media_sha256 == hashlib.sha256(stored).hexdigest()
    assert rows[4][1:] == rows[5][1:] == rows[99][1:]
    assert m.media_features(docs).count() == docs.count() and m.media_features(none).count() == 0


def test_packet_table(spark):
    whole = m.mux(b"y" * 6400)
    df = spark.createDataFrame([(1, bytearray(whole)), (2, None), (3, bytearray(b"nothing"))], "id int, media binary")
    parsed = {r.id: r.parsed for r in m.parse_column(df, "media").collect()}
    assert parsed[2] is None and parsed[3].error and not parsed[3].packets and len(parsed[1].cues) == 1
    table = m.packet_table(df, "media", ["id"]).orderBy("offset").collect()
    assert b"".join(whole[r.offset : r.offset + r.size] for r in table) == b"y" * 6400 and {r.id for r in table} == {1}
