"""Exact SentencePiece BPE encoding by backtracking, and decoding.

Merging the best pair again and again gives one special segmentation: the one in
which every two neighbouring tokens are *compatible*, that is, merging the
characters of the two from scratch gives the same two tokens. So a text is
encoded left to right: take the longest token that starts here (Aho-Corasick),
check it against the token before, fall back to the next shorter one, and step
back when none fits. A bitfield remembers positions from which no way on exists,
so each position fails at most once.

Characters that stand side by side in no token never meet in a merge, so texts fall
apart between them (at white space, before most punctuation). Equal parts of a
batch of texts are encoded once, and all distinct parts side by side: the automaton
and the backtracking take one step of every part at a time, as array operations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Bytes of text that are encoded at once (or one text), and parts of them that take their steps together.
SLICE = 1 << 21
TOGETHER = 1 << 14
#: Characters of the longest part that is encoded side by side with others: its failed positions fit one word.
LONGEST = 63
#: Compatible and incompatible pairs of tokens that a worker remembers.
PAIRS = 1 << 18


class Table:
    """Numbers by number: open addressing, looked up and filled for whole arrays; -1 where there is none."""

    def __init__(self, bits: int):
        self.bits, self.size = bits, 0
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.zeros(1 << bits, dtype=np.int32)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._first(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], -1)
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
            place, own = at[todo], keys[todo]
            found = self.keys[place]
            out[todo] = np.where(found == own, self.values[place], -1)
            todo = todo[(found != own) & (found != -1)]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """New keys, each once; the table must have room for twice as many."""
        at, todo = self._first(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[at[todo]] == -1]
            self.keys[at[free]] = keys[free]  # one of those that want a slot gets it
            won = free[self.keys[at[free]] == keys[free]]
            self.values[at[won]] = values[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
        self.size += len(keys)


class Encoder:
    """Encodes like the sentencepiece library with this model, without begin or end ids."""

    def __init__(self, model: bytes):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        if spec.model_type != spec.BPE:
            raise ValueError("the model is not of merge type")
        if any(p.type in (USER, UNUSED) for p in proto.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.identity = norm.name == "identity" and not norm.precompiled_charsmap
        if norm.remove_extra_whitespaces or not norm.escape_whitespaces or not self.identity:
            raise ValueError("only models that leave the text as it is are supported")
        self.dummy_prefix = norm.add_dummy_prefix
        self.pieces = [p.piece for p in proto.pieces]
        self.types = [p.type for p in proto.pieces]
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.unknown_surface = spec.unk_surface
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE} if spec.byte_fallback else {}
        self.byte_values = {i: b for b, i in self.bytes.items()}
        # Tokens that merging can end in: those that their own characters merge to.
        self.reachable = {t for t in self.ids if self._merged(t) == [t]}
        self.automaton = ahocorasick.Automaton()
        for t in self.reachable:
            self.automaton.add_word(t, (t, len(t) - 1))
        self.automaton.make_automaton()
        #: The longest token that is a proper prefix of each token.
        self.shorter = {t: next((t[:k] for k in range(len(t) - 1, 0, -1) if t[:k] in self.reachable), None) for t in self.reachable}
        self.alphabet = frozenset(t for t in self.reachable if len(t) == 1)
        self.surfaces = [self._surface(i) for i in range(len(self.pieces))]
        self.compatible = lru_cache(maxsize=1 << 16)(self._compatible)
        self.pairs = Table((2 * PAIRS - 1).bit_length())
        self._tables()

    def _tables(self) -> None:
        """What encoding of many parts at once looks up: characters, the automaton, tokens, where texts fall apart."""
        ids = {t: self.ids[t] for t in self.reachable}
        met = sorted({c for t in ids if len(t) > 1 for c in t})
        #: Class of each character, 0 for those in no longer token; the token that it is alone, -1 if it is none.
        self.classes, self.single = np.zeros(0x110000, dtype=np.int32), np.full(0x110000, -1, dtype=np.int32)
        self.classes[[ord(c) for c in met]] = np.arange(1, len(met) + 1)
        self.single[[ord(c) for c in self.alphabet]] = [ids[c] for c in self.alphabet]
        for table in (self.classes, self.single):
            table[ord(" ")] = table[ord(MARK)]
        # The automaton reads from right to left, so where it stands tells the longest token that starts there.
        self.width = len(met) + 1
        children: list[dict[int, int]] = [{}]
        token, parent, via = [-1], [0], [0]
        for t, i in ids.items():
            at = 0
            for c in map(int, self.classes[[ord(x) for x in reversed(t)]]):
                if c == 0:
                    at = 0
                    break
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    token.append(-1)
                    parent.append(at)
                    via.append(c)
                at = children[at][c]
            if at:
                token[at] = i
        back, order = [0] * len(children), list(children[0].values())
        for node in order:
            order.extend(children[node].values())
            if parent[node]:
                f = back[parent[node]]
                while f and via[node] not in children[f]:
                    f = back[f]
                back[node] = children[f].get(via[node], 0)
            if token[node] < 0:
                token[node] = token[back[node]]
        self.back, self.token = np.array(back, dtype=np.int64), np.array(token, dtype=np.int32)
        edges = [(n * self.width + c, m) for n, own in enumerate(children) for c, m in own.items()]
        self.goto = Table((2 * len(edges)).bit_length())
        self.goto.add(np.array([e[0] for e in edges], dtype=np.int64), np.array([e[1] for e in edges], dtype=np.int32))
        self.length, self.next = np.ones(len(self.pieces), dtype=np.int64), np.full(len(self.pieces), -1, dtype=np.int32)
        for t, i in ids.items():
            self.length[i] = len(t)
            if self.shorter[t] is not None:
                self.next[i] = ids[self.shorter[t]]
        # Neighbours that some token has. Runs of characters outside the vocabulary are one unknown token, unless they fall into bytes.
        self.joined = np.zeros((256, 256), dtype=bool)
        self.joined[128:, :] = self.joined[:, 128:] = True
        if not self.bytes:
            outside = [i for i in range(128) if chr(i) != " " and chr(i) not in self.alphabet]
            self.joined[outside, :] = self.joined[:, outside] = True
        plain = lambda c: 0x20 if c == MARK else min(ord(c), 128)
        seen = {(plain(a), plain(b)) for t in ids for a, b in zip(t, t[1:], strict=False)}
        for a, b in seen:
            self.joined[a if a < 128 else slice(128, 256), b if b < 128 else slice(128, 256)] = True
        if (128, 0x20) not in seen:
            self.joined[128:, 0x20] = False  # white space behind a character of several bytes ...
            self.joined[MARK.encode()[-1], 0x20] = self.joined[0x20, 0x20]  # ... unless it may be the mark itself
        self.id_texts = pa.array([f"{i},".encode() for i in range(len(self.pieces))], pa.large_binary())
        self.id_surfaces = pa.array(self.surfaces, pa.large_binary())

    def _merged(self, text: str) -> list[str]:
        """Plain merging: the pair of best score first, the left one of equals. For short texts."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, left: str, right: str) -> bool:
        """Merging the two again, character by character, ends in the same two: no merge ever takes in both sides."""
        parts, scores, seam = [*left, *right], self.scores, len(left)
        while len(parts) > 1:
            best, at, begin, where = None, -1, 0, 0
            for i in range(len(parts) - 1):
                s = scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at, where = s, i, begin
                begin += len(parts[i])
            if best is None:
                break
            if where < seam < where + len(parts[at]) + len(parts[at + 1]):
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts == [left, right]

    def _segments(self, text: str) -> list[str]:
        """The tokens of a text whose characters are all in the vocabulary."""
        n = len(text)
        longest: list[str | None] = [None] * n
        for end, (token, back) in self.automaton.iter(text):
            longest[end - back] = token  # ends rise, so the longest comes last
        failed, shorter, compatible = bytearray(n // 8 + 1), self.shorter, self.compatible
        tokens: list[str] = []
        before, at, token = None, 0, longest[0]
        while True:
            while token is not None:
                end = at + len(token)
                if not failed[end >> 3] >> (end & 7) & 1 and (before is None or compatible(before, token)):
                    break
                token = shorter[token]
            if token is None:  # no way on from here: step back to the token before
                failed[at >> 3] |= 1 << (at & 7)
                token = tokens.pop()
                at -= len(token)
                before, token = tokens[-1] if tokens else None, shorter[token]
                continue
            tokens.append(token)
            if end == n:
                return tokens
            before, at, token = token, end, longest[end]

    def _chunk(self, text: str) -> list[int]:
        """Ids of one chunk; characters outside the vocabulary stand alone."""
        ids = self.ids
        if self.alphabet.issuperset(text):
            return [ids[t] for t in self._segments(text)] if text else []
        out: list[int] = []
        for known, part in self._runs(text):
            if known:
                out += [ids[t] for t in self._segments(part)]
            elif self.bytes:
                out += [self.bytes[b] for b in part.encode("utf-8")]
            else:
                out.append(self.unknown)  # a run of unknown characters is one unknown piece
        return out

    def _runs(self, text: str) -> Iterator[tuple[bool, str]]:
        begin = 0
        for i in range(1, len(text) + 1):
            if i == len(text) or (text[i] in self.reachable) != (text[begin] in self.reachable):
                yield text[begin] in self.reachable, text[begin:i]
                begin = i

    def _escaped(self, text: str) -> str:
        return ((MARK if self.dummy_prefix else "") + text.replace(" ", MARK)) if text else ""

    def encode(self, text: str) -> list[int]:
        """The ids of one text, read from left to right without tables."""
        return self._chunk(self._escaped(text))

    def decode(self, ids: list[int]) -> str:
        """Like the library's decode(ids): bytes join to UTF-8, the dummy prefix goes, control ids give nothing."""
        return self._finish(b"".join([self.surfaces[i] for i in ids]))

    def _surface(self, i: int) -> bytes:
        if i in self.byte_values:
            return bytes([self.byte_values[i]])
        if self.types[i] == CONTROL:
            return b""
        if i == self.unknown:
            return self.unknown_surface.encode()
        return self.pieces[i].replace(MARK, " ").encode()

    def _finish(self, out: bytes) -> str:
        if self.dummy_prefix and out.startswith(b" "):
            out = out[1:]
        return out.decode("utf-8", "replace")

    # --- many texts at once ---------------------------------------------------------------------------------------

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of all texts: text ``i`` has ``ids[bounds[i]:bounds[i+1]]``; a null is an empty text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.dummy_prefix:
            texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
        _, offsets, data = texts.buffers()
        limits = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, dtype=np.uint8)[limits[0] : limits[-1]] if data is not None and limits[-1] else np.empty(0, dtype=np.uint8)
        limits = limits - limits[0]
        begins = np.zeros(len(raw) + 1, dtype=bool)
        if len(raw):
            begins[1:-1] = ~self.joined[raw[:-1], raw[1:]]
        begins[limits] = True
        edges = np.flatnonzero(begins)
        if len(edges) < 2:
            return np.empty(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(raw))])
        coded = parts.dictionary_encode()
        values, starts, lengths = self._encode_parts(coded.dictionary)
        which = coded.indices.to_numpy()
        each = lengths[which]
        upto = np.concatenate([[0], np.cumsum(each)])
        ids = values[np.repeat(starts[which] - upto[:-1], each) + np.arange(upto[-1])]
        return ids, upto[np.searchsorted(edges, limits)]

    def digests(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[list[str], list[str]]:
        """sha256 of each text's ids, joined by commas, and of the text decoded from them."""
        out = []
        for table in (self.id_texts, self.id_surfaces):
            taken = table.take(pa.array(ids))
            _, offsets, data = taken.buffers()
            limits = np.frombuffer(offsets, dtype=np.int64)[bounds] if len(ids) else np.zeros(len(bounds), dtype=np.int64)
            view = memoryview(data) if data is not None else memoryview(b"")
            texts = [view[a:z] for a, z in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True)]
            if table is self.id_texts:
                out.append([hashlib.sha256(t[:-1]).hexdigest() for t in texts])
            else:
                out.append([hashlib.sha256(self._finish(bytes(t)).encode()).hexdigest() for t in texts])
        return out[0], out[1]

    def _encode_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(values, starts, lengths): the ids of distinct parts, in any order."""
        texts = parts.cast(pa.large_string())  # cut behind or before single bytes only, so each is whole
        sizes = pc.utf8_length(texts).to_numpy()
        _, offsets, data = texts.buffers()
        last = np.frombuffer(offsets, dtype=np.int64)[len(texts)]
        points = np.frombuffer(str(memoryview(data)[:last], "utf-8").encode("utf-32-le"), dtype=np.uint32)
        begin = np.cumsum(sizes) - sizes
        strange = np.add.reduceat(self.single[points] < 0, begin) > 0
        alone = (sizes > LONGEST) | strange
        starts, lengths = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
        found, total = [np.empty(0, dtype=np.int32)], 0
        order = np.flatnonzero(~alone)
        order = order[np.argsort(-sizes[order], kind="stable")]
        for i in range(0, len(order), TOGETHER):
            own = order[i : i + TOGETHER]
            values, lengths[own] = self._together(points, begin[own], sizes[own])
            starts[own] = total + np.cumsum(lengths[own]) - lengths[own]
            found.append(values)
            total += len(values)
        for i in np.flatnonzero(alone):
            ids = self._chunk(texts[int(i)].as_py().replace(" ", MARK))
            starts[i], lengths[i] = total, len(ids)
            found.append(np.array(ids, dtype=np.int32))
            total += len(ids)
        return np.concatenate(found), starts, lengths

    def _longest(self, points: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The longest token at each place of each part (a row a part); parts come by falling size."""
        out = np.full((len(begin), int(sizes[0])), -1, dtype=np.int32)
        state = np.zeros(len(begin), dtype=np.int64)
        for k in range(int(sizes[0])):
            n = int(np.searchsorted(-sizes, -k, side="left"))  # parts of more than k characters
            place = sizes[:n] - 1 - k
            point = points[begin[:n] + place]
            kind = self.classes[point].astype(np.int64)
            now, todo = state[:n], np.arange(n)
            reached = np.zeros(n, dtype=np.int64)
            while len(todo):
                at = now[todo]
                next_ = self.goto.find(at * self.width + kind[todo])
                done = (next_ >= 0) | (at == 0)
                reached[todo[done]] = np.maximum(next_[done], 0)
                todo = todo[~done]
                now[todo] = self.back[now[todo]]
            state[:n] = reached
            token = self.token[reached]
            out[np.arange(n), place] = np.where(token >= 0, token, self.single[point])
        return out

    def _together(self, points: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, lengths): backtracking of all parts, a step of each at a time."""
        longest = self._longest(points, begin, sizes)
        n = len(begin)
        kept, depth = np.full((n, int(sizes[0])), -1, dtype=np.int32), np.zeros(n, dtype=np.int64)
        at, failed = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.uint64)
        token, before = longest[:, 0].copy(), np.full(n, -1, dtype=np.int32)
        live, one = np.arange(n), np.uint64(1)
        while len(live):
            own = token[live]
            some = own >= 0
            end = at[live] + np.where(some, self.length[own], 0)
            fits = some & ((failed[live] >> end.astype(np.uint64)) & one == 0)
            check = np.flatnonzero(fits & (before[live] >= 0))
            fits[check] = self._compatible_pairs(before[live[check]], own[check])
            # Taken: go on behind the token.
            a = live[fits]
            kept[a, depth[a]] = own[fits]
            depth[a] += 1
            before[a], at[a] = own[fits], end[fits]
            done = at[a] == sizes[a]
            more = a[~done]
            token[more] = longest[more, at[more]]
            # Not taken: the next shorter one.
            b = live[some & ~fits]
            token[b] = self.next[token[b]]
            # None left: step back to the token before.
            c = live[~some]
            failed[c] |= one << at[c].astype(np.uint64)
            depth[c] -= 1
            last = kept[c, depth[c]]
            at[c] -= self.length[last]
            token[c] = self.next[last]
            before[c] = np.where(depth[c] > 0, kept[c, depth[c] - 1], -1)
            gone = np.zeros(len(live), dtype=bool)
            gone[np.flatnonzero(fits)[done]] = True
            live = live[~gone]
        return kept[np.arange(kept.shape[1]) < depth[:, None]], depth

    def _compatible_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        codes, n = left.astype(np.int64) * len(self.pieces) + right, len(self.pieces)
        found = self.pairs.find(codes)
        missed = found < 0
        if missed.any():
            new, which = np.unique(codes[missed], return_inverse=True)
            fit = np.array([self._compatible(self.pieces[c // n], self.pieces[c % n]) for c in new.tolist()], dtype=np.int32)
            found[missed] = fit[which]
            if self.pairs.size + len(new) > PAIRS:
                self.pairs = Table((2 * max(PAIRS, len(new))).bit_length())
            self.pairs.add(new, fit)
        return found == 1


_encoders: dict[bytes, Encoder] = {}


def encoder_of(model: bytes) -> Encoder:
    """One encoder a process and model."""
    key = hashlib.sha256(model).digest()
    if key not in _encoders:
        _encoders[key] = Encoder(model)
    return _encoders[key]


def load(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model: bytes, with_ids: bool = False, text: str = "text") -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256 (and ids) to the rows' other columns except the text.

    Null and empty texts have no ids; repeated rows give repeated rows. Columns of
    those names in ``docs`` are replaced. An empty table gives no rows. The model (half a megabyte) goes to the workers with the function.
    """
    new = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        new.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    names = {f.name.lower() for f in new}
    kept = [f for f in docs.schema.fields if f.name != text and f.name.lower() not in names]
    schema = T.StructType(kept + new)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder_of(shared.value)
        for b in batches:
            texts = b.column(b.schema.get_field_index(text))
            for a, z in slices(texts, SLICE):
                part = b.slice(a, z - a)
                ids, bounds = e.ids_of(texts.slice(a, z - a))
                columns = [part.column(b.schema.get_field_index(f.name)) for f in kept]
                columns.append(pa.array(np.diff(bounds), pa.int64()))
                columns += [pa.array(d, pa.string()) for d in e.digests(ids, bounds)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return docs.select(*[f"`{f.name}`" for f in kept], text).mapInArrow(run, schema)
