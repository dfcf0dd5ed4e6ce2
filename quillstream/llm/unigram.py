"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

The pieces and scores come from a model file; the segmentation is the one with the highest
sum of scores.  Characters that no piece covers become byte pieces.  Spaces are written
as a marker, one more marker stands before the text, and decoding turns them back.

No piece holds a marker behind another character (checked on loading), so segments end at
word starts, and each ``marker word`` chunk is segmented on its own, each distinct one once
per task as long as the memory of them (``MEMO``) lasts.  The new chunks of a group of texts
are segmented side by side: one array step takes all of them a byte further in the trie.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.llm.common import set_aside

MARK = "▁"
# Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# Fixed value: how far an uncovered character scores below the worst piece.
UNKNOWN_PENALTY = 10.0
MEMO = 300_000
# Bytes of the longest chunk that is remembered and segmented beside others.
MEMO_LENGTH = 64
# Characters of the texts whose chunks are held at a time.
GROUP = 1 << 20


def _fields(data: bytes):
    """(field number, value) of a serialized message: ints, 4-byte and byte values."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield tag >> 3, data[at:at + size]
            at += size


def read_pieces(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, type) of a model file, in order of ids.

    Texts are encoded as they are, with a marker before them; a model that asks for another
    treatment is refused.
    """
    with open(path, "rb") as f:
        raw = f.read()
    pieces = []
    for field, value in _fields(raw):
        if field == 2 and dict(_fields(value)).get(24):
            raise ValueError("markers behind words are not supported")
        if field == 3:
            # Character map, prefix, white space to drop and to mark, by number.
            rules = {2: b"", 3: 1, 4: 1, 5: 1} | dict(_fields(value))
            if rules[2] or rules[4] or not rules[3] or not rules[5]:
                raise ValueError("only models that leave texts as they are are supported")
        if field == 1:
            own = dict(_fields(value))
            pieces.append((own[1].decode(), struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0], own.get(3, NORMAL)))
    return pieces


class DoubleArray:
    """Trie over byte strings: a state's child for byte ``b`` is at ``base[state] + b + 1``,
    if ``check`` there names the state.  ``value`` holds the piece that ends at a state."""

    def __init__(self, words: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for word, value in words.items():
            node = 0
            for b in word:
                nxt = children[node].get(b)
                if nxt is None:
                    nxt = children[node][b] = len(children)
                    children.append({})
                    ends.append(-1)
                node = nxt
            ends[node] = value
        size = 2 * len(children) + 600
        base, check, value = array("i", [0]) * size, array("i", [-1]) * size, array("i", [-1]) * size
        check[0] = 0
        # Searches for a node of as many children start where the last one ended.
        free_from, queue, tried = 1, [(0, 0)], [0] * 257
        for node, state in queue:
            value[state] = ends[node]
            codes = sorted(children[node])
            if not codes:
                continue
            while check[free_from] >= 0:
                free_from += 1
            at = max(free_from - codes[0] - 1, tried[len(codes)])
            while any(check[at + c + 1] >= 0 for c in codes):
                at += 1
                if at + 300 > len(check):
                    for x, fill in ((base, 0), (check, -1), (value, -1)):
                        x.extend([fill] * size)
            base[state] = tried[len(codes)] = at
            for c in codes:
                check[at + c + 1] = state
                queue.append((children[node][c], at + c + 1))
        base.extend([0] * 300)
        check.extend([-1] * 300)
        value.extend([-1] * 300)
        self.base, self.check, self.value = base, check, value


class Unigram:
    """Encoder and decoder of one model."""

    def __init__(self, path: str):
        pieces = read_pieces(path)
        self.byte_ids = [0] * 256
        normal = [s for _, s, t in pieces if t == NORMAL]
        self.unknown_score = min(normal) - UNKNOWN_PENALTY
        words, self.scores, self.raw = {}, [0.0] * len(pieces), []
        for i, (piece, score, kind) in enumerate(pieces):
            raw = piece.encode()
            self.raw.append(b"" if kind in (CONTROL, UNKNOWN) else raw.replace(MARK.encode(), b" "))
            if kind == BYTE:
                self.byte_ids[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif kind in (NORMAL, USER_DEFINED):
                words[raw] = i
                # A user-defined piece always beats what it could be made of.
                self.scores[i] = score if kind == NORMAL else len(raw) * max(normal) - 0.1
        self.is_byte = np.zeros(len(pieces), bool)
        self.is_byte[self.byte_ids] = True
        if not self.is_byte.sum() == 256:
            raise ValueError("a piece for every byte is needed")
        inner = any(MARK in p.lstrip(MARK) for p, _, t in pieces if t in (NORMAL, USER_DEFINED))
        self.inner = inner
        self.chunks = re.compile(r"(?s).+" if inner else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.trie = DoubleArray(words)

    def segment(self, text: str) -> list[int]:
        """Viterbi over one chunk; among equal sums the last piece that starts first wins."""
        raw = text.encode()
        n, none = len(raw), float("-inf")
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        best, back = [none] * (n + 1), [(0, -1)] * (n + 1)
        best[0] = 0.0
        at = 0
        while at < n:
            lead = raw[at]
            width = 1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4
            here, state, single = best[at], 0, False
            for to in range(at, n):
                nxt = base[state] + raw[to] + 1
                if check[nxt] != state:
                    break
                state = nxt
                piece = value[state]
                if piece >= 0:
                    if here + scores[piece] > best[to + 1]:
                        best[to + 1] = here + scores[piece]
                        back[to + 1] = (at, piece)
                    single |= to + 1 - at == width
            if not single and here + self.unknown_score > best[at + width]:
                best[at + width] = here + self.unknown_score
                back[at + width] = (at, -1)
            at += width
        out, to = [], n
        while to:
            at, piece = back[to]
            out += [piece] if piece >= 0 else [self.byte_ids[b] for b in reversed(raw[at:to])]
            to = at
        return out[::-1]

    def segment_many(self, chunks: list[bytes]) -> list[bytes]:
        """``segment`` of many short chunks, side by side; ids as 32-bit numbers."""
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        out: list[bytes] = [b""] * len(chunks)
        for low, high in ((0, 8), (8, 12), (12, 20), (20, 36), (36, 1 << 20)):
            own = np.flatnonzero((size > low) & (size <= high))
            for at in range(0, len(own), 1 << 16):
                part = own[at:at + (1 << 16)]
                for i, ids in zip(part.tolist(), self._side_by_side([chunks[i] for i in part.tolist()], size[part])):
                    out[i] = ids
        return out

    def _side_by_side(self, chunks: list[bytes], size: np.ndarray) -> list[bytes]:
        n, width = len(chunks), int(size.max())
        data = np.frombuffer(b"".join(c.ljust(width + 1, b"\0") for c in chunks), np.uint8).reshape(n, width + 1).astype(np.int32)
        base, check, value = (np.frombuffer(x, np.int32) for x in (self.trie.base, self.trie.check, self.trie.value))
        scores = np.asarray(self.scores)
        best, back = np.full((n, width + 1), -np.inf), np.zeros((n, width + 1), np.int32)
        piece_at = np.full((n, width + 1), -1, np.int32)
        best[:, 0] = 0
        for at in range(width):
            # Characters start where a byte is no continuation.
            rows = np.flatnonzero((size > at) & ((data[:, at] & 0xC0) != 0x80))
            if not len(rows):
                continue
            lead = data[rows, at]
            end = at + np.where(lead < 128, 1, np.where(lead < 224, 2, np.where(lead < 240, 3, 4)))
            here, single = best[rows, at], np.zeros(len(rows), bool)
            state, active = np.zeros(len(rows), np.int32), np.arange(len(rows))
            for to in range(at, width):
                nxt = base[state] + data[rows[active], to] + 1
                found = (check[nxt] == state) & (size[rows[active]] > to)
                active, state = active[found], nxt[found]
                if not len(active):
                    break
                piece = value[state]
                hit = piece >= 0
                who, piece = active[hit], piece[hit]
                sums, row = here[who] + scores[piece], rows[who]
                better = sums > best[row, to + 1]
                row = row[better]
                best[row, to + 1], back[row, to + 1], piece_at[row, to + 1] = sums[better], at, piece[better]
                single[who] |= end[who] == to + 1
            alone, to = rows[~single], end[~single]
            better = best[alone, at] + self.unknown_score > best[alone, to]
            alone, to = alone[better], to[better]
            best[alone, to], back[alone, to], piece_at[alone, to] = best[alone, at] + self.unknown_score, at, -1
        # From the ends back: entries of each chunk in reverse, then scattered to their places.
        who, place, ids = [], [], []
        count, to, rows = np.zeros(n, np.int64), size.copy(), np.arange(n)
        bytes_ = np.asarray(self.byte_ids)
        while len(rows):
            end = to[rows]
            piece, begin = piece_at[rows, end], back[rows, end]
            covered = piece >= 0
            for step in range(4):
                one = covered if step == 0 else np.zeros(len(rows), bool)
                some = one | (~covered & (end - step > begin))
                if not some.any():
                    break
                row = rows[some]
                who.append(row)
                place.append(count[row])
                ids.append(np.where(one[some], piece[some], bytes_[data[row, end[some] - 1 - step]]))
                count[row] += 1
            to[rows] = begin
            rows = rows[begin > 0]
        ends = np.cumsum(count)
        who, place, ids = map(np.concatenate, (who, place, ids))
        flat = np.empty(int(ends[-1]), "<i4")
        flat[ends[who] - 1 - place] = ids
        raw, cuts = flat.tobytes(), (ends * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts)]

    def memory(self) -> "Memory":
        return Memory(self)

    def encoder(self):
        """A function from text to ids as 32-bit little-endian bytes, with its own memory."""
        memory = self.memory()
        return lambda text: next(memory.encode([text]))[0]

    def decode(self, ids) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        return raw.decode("utf-8", "replace").removeprefix(" ")


class Memory:
    """Encoder of groups of texts that remembers the ids of short chunks.

    A chunk is known by what follows its first marker.  ``odd`` names the chunks whose ids do
    not decode to the chunk.
    """

    def __init__(self, model: Unigram):
        self.model, self.known, self.odd = model, {}, set()

    def _keys(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.model.inner and MARK not in text:
            words = text.split(" ")
            if "" not in words:
                return words
        return [c[1:] for c in self.model.chunks.findall(MARK + text.replace(" ", MARK))]

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        raw = [(MARK + k).encode() for k in new]
        short = [i for i, r in enumerate(raw) if len(r) <= MEMO_LENGTH]
        found = dict(zip((new[i] for i in short), self.model.segment_many([raw[i] for i in short])))
        self.known.update(found)
        extra = {k: np.array(self.model.segment(MARK + k), "<i4").tobytes() for k, r in zip(new, raw) if len(r) > MEMO_LENGTH}
        mark, surface = MARK.encode(), self.model.raw.__getitem__
        for k, r in zip(new, raw):
            ids = found.get(k) or extra[k]
            if b"".join(map(surface, struct.unpack(f"<{len(ids) // 4}i", ids))) != r.replace(mark, b" "):
                self.odd.add(k)
        return extra

    def encode(self, texts):
        """(ids as 32-bit little-endian bytes, whether every chunk decodes to itself) of each text."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > GROUP:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]):
        keys = [self._keys(t) for t in texts]
        wanted = set().union(*keys)
        if len(self.known) + len(wanted) > MEMO:
            self.known.clear()
            self.odd.clear()
        extra = self._learn([k for k in wanted if k not in self.known])
        ids = ({k: extra.get(k) or self.known[k] for k in wanted} if extra else self.known).__getitem__
        for own in keys:
            yield b"".join(map(ids, own)), self.odd.isdisjoint(own)


def _loaded(docs: DataFrame, model: str):
    """The encoder, broadcast: its size is that of the vocabulary."""
    return docs.sparkSession.sparkContext.broadcast(Unigram(model))


def _texts(column: pa.Array):
    return (x.as_py() or "" for x in column)


def encode(docs: DataFrame, model: str, column: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` as array<int> in ``column`` (replaced if there).

    Null and empty texts have no ids.  All other columns, repeated rows included, are kept.
    """
    shared = _loaded(docs, model)
    # ``mapInArrow`` itself cannot take names with dots.
    apart, back = set_aside(docs.drop(column), "text")
    place, names = apart.columns.index("text"), [*apart.columns, "_ids"]

    def run(batches):
        memory = shared.value.memory()
        for batch in batches:
            ids = [np.frombuffer(raw, "<i4") for raw, _ in memory.encode(_texts(batch.column(place)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], names)

    schema = T.StructType([*apart.schema.fields, T.StructField("_ids", T.ArrayType(T.IntegerType()))])
    return apart.mapInArrow(run, schema).select(*back, F.col("_ids").alias(column))


def decode(rows: DataFrame, model: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``rows`` with the text of ``ids`` in ``column`` (replaced if there); null ids give null."""
    shared = _loaded(rows, model)
    apart, back = set_aside(rows.drop(column), ids)
    place, names = apart.columns.index(ids), [*apart.columns, "_decoded"]

    def run(batches):
        model_ = shared.value
        for batch in batches:
            texts = [None if x.as_py() is None else model_.decode(x.as_py()) for x in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    schema = T.StructType([*apart.schema.fields, T.StructField("_decoded", T.StringType())])
    return apart.mapInArrow(run, schema).select(*back, F.col("_decoded").alias(column))


def digest(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_pieces, n_byte_pieces, ids_sha256, restored) of every row.

    ``ids_sha256`` is over the ids as 32-bit little-endian numbers; ``restored`` tells
    whether decoding gives the text back (markers inside a text come back as spaces).  Null
    texts count as empty: no pieces, and restored.
    """
    shared = _loaded(docs, model)
    rows = docs.select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        model_ = shared.value
        memory = model_.memory()
        for batch in batches:
            out, texts = [], list(_texts(batch.column(1)))
            for text, (raw, whole) in zip(texts, memory.encode(texts)):
                ids = np.frombuffer(raw, "<i4")
                # A text whose chunks all decode to themselves is restored; any other is decoded.
                out.append((len(ids), int(model_.is_byte[ids].sum()), hashlib.sha256(raw).hexdigest(),
                            whole or model_.decode(ids.tolist()) == text.replace(MARK, " ")))
            n, b, h, r = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(b, pa.int64()), pa.array(h, pa.string()),
                 pa.array(r, pa.bool_())], ["doc_id", "n_pieces", "n_byte_pieces", "ids_sha256", "restored"])

    return rows.mapInArrow(run, f"doc_id {id_type}, n_pieces bigint, n_byte_pieces bigint, "
                                "ids_sha256 string, restored boolean")
