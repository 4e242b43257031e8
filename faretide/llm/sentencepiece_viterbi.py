r"""SentencePiece encoding and decoding with a piece table: Aho-Corasick and Viterbi.

The normal form of the piece file holds: blanks become U+2581, one is put in front. The best segmentation has the
largest sum of piece scores. An Aho-Corasick automaton over the pieces' bytes reads the text once; at each position its
output links name all pieces that end there, longest first, and each relaxes the best score of the position.
A character that no piece covers is spelled as byte pieces, each at ``unknown`` below the least score.

No piece has U+2581 behind another character, so the best segmentation of a text is that of its chunks: blanks and the
characters up to the next blank. Chunks are told apart per batch, and the automaton steps through all different
chunks at once, a byte at a time, with numpy. Chunks with characters that need byte pieces go the same way: the byte
pieces are part of the automaton's table.

Ties go to the segmentation whose last piece is longer. Decoding puts the pieces' bytes together, turns U+2581 into
blanks and drops the one in front: the round trip is exact, except that U+2581 in a text comes back as a blank and
a byte sequence is decoded as UTF-8.

Defined results: a null text gives null ids, an empty one no ids; repeated rows are encoded each on its own; other
columns are kept by ``encode`` and ``decode``, which add ``ids``, ``n_ids`` and ``decoded``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from faretide.llm import arrays

META = "▁".encode()
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6  # kinds of pieces in the file


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int | float]]:
    """(number, value) of a message's fields in the wire format of the model file."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size
        elif kind == 5:
            yield tag >> 3, struct.unpack("<f", data[at : at + 4])[0]
            at += 4
        else:
            yield tag >> 3, data[at : at + 8]
            at += 8


def read_pieces(model: bytes) -> list[tuple[bytes, float, int]]:
    """(piece, score, kind) by id."""
    pieces = []
    for number, value in _fields(model):
        if number == 1:
            own = dict(_fields(value))
            pieces.append((own.get(1, b""), own.get(2, 0.0), own.get(3, NORMAL)))
    return pieces


class Automaton:
    """The pieces' Aho-Corasick automaton as arrays; states are numbered by depth."""

    def __init__(self, model: bytes, unknown: float = 10.0):
        self.pieces = read_pieces(model)
        spelled = [(p, s, i) for i, (p, s, kind) in enumerate(self.pieces) if kind in (NORMAL, USER) and p]
        if any(b" " in p.replace(META, b" ").lstrip(b" ") for p, _, _ in spelled):
            raise ValueError("a piece holds a blank behind another character, so texts cannot be cut at blanks")
        least = min((s for _, s, _ in spelled), default=0.0)
        single = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE}
        unknown_id = next((i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN), 0)
        for byte in range(256):
            # A byte piece alone never beats a piece that covers the byte's whole character.
            spelled.append((bytes([byte]), least - unknown, single.get(byte, unknown_id)))
        tree: list[dict[int, int]] = [{}]
        end: dict[int, tuple[int, float, int]] = {}
        for piece, score, i in spelled:
            state = 0
            for byte in piece:
                state = tree[state].setdefault(byte, len(tree))
                if state == len(tree):
                    tree.append({})
            if state not in end or score > end[state][1]:
                end[state] = (i, score, len(piece))
        n = len(tree)
        # All moves, fail links followed: by rising depth, a state's moves are its fail state's, overwritten by its own.
        self.go = np.zeros((n, 256), np.int32)
        fail = np.zeros(n, np.int32)
        self.link = np.zeros(n, np.int32)  # the next shorter piece that ends here; 0: none
        level = [0]
        while level:
            below = []
            for state in level:
                if state:
                    self.go[state] = self.go[fail[state]]
                    self.link[state] = fail[state] if fail[state] in end else self.link[fail[state]]
                for byte, child in tree[state].items():
                    fail[child] = self.go[fail[state], byte] if state else 0
                    below.append(child)
                for byte, child in tree[state].items():
                    self.go[state, byte] = child
            level = below
        self.id, self.score, self.size = np.full(n, -1, np.int32), np.zeros(n), np.zeros(n, np.int32)
        for state, (i, score, size) in end.items():
            self.id[state], self.score[state], self.size[state] = i, score, size
        self.bytes_of = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind in (CONTROL, UNKNOWN) else p for p, _, kind in self.pieces]

    def segment(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks behind one another, and where each chunk's begin; one more for the end."""
        sizes = np.array([len(c) for c in chunks], np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        n, longest = len(chunks), int(sizes[0]) if len(sizes) else 0
        width = longest + 1
        data = np.zeros((longest, n), np.uint8)  # a row for each position
        flat = np.frombuffer(b"".join(chunks[i] for i in order), np.uint8)
        column = np.repeat(np.arange(n), sizes)
        row = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        data[row, column] = flat
        best = np.full((width, n), -np.inf)
        best[0] = 0
        taken = np.zeros((width, n), np.int32)  # the state whose piece ends here
        state = np.zeros(n, np.int32)
        active = np.searchsorted(-sizes, -np.arange(1, width), side="right")  # chunks that have the position
        for t in range(longest):
            m = int(active[t])
            state = self.go[state[:m], data[t, :m]]
            output = np.where(self.id[state] >= 0, state, self.link[state])
            who = np.arange(m)
            while len(who):
                found = best[t + 1 - self.size[output], who] + self.score[output]
                better = found > best[t + 1, who]
                best[t + 1, who[better]] = found[better]
                taken[t + 1, who[better]] = output[better]
                output = self.link[output]
                more = output > 0
                who, output = who[more], output[more]
        at, who, steps = sizes.copy(), np.arange(n), []
        while len(who):
            piece = taken[at[who], who]
            steps.append((who, self.id[piece]))
            at[who] -= self.size[piece]
            who = who[at[who] > 0]
        counts = np.zeros(n, np.int64)
        for who, _ in steps:
            counts[who] += 1
        back = np.empty(n, np.int64)
        back[order] = np.arange(n)
        own = counts[back]
        bounds = np.r_[0, np.cumsum(own)]
        ids = np.empty(int(bounds[-1]), np.int32)
        end = bounds[1:][order]
        for k, (who, found) in enumerate(steps):
            ids[end[who] - 1 - k] = found
        return ids, bounds

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """The ids of each text, by its different chunks."""
        numbers: dict[bytes, int] = {}
        lists = [[numbers.setdefault(c, len(numbers)) for c in chunks(t)] if t is not None else None for t in texts]
        if not numbers:
            return [np.zeros(0, np.int32) if x is not None else None for x in lists]
        names = list(numbers)
        ids, bounds = self._in_groups(names)
        out = []
        for own in lists:
            if own is None:
                out.append(None)
                continue
            which = np.array(own, np.int64)
            low, size = bounds[which], bounds[which + 1] - bounds[which]
            first = np.repeat(np.cumsum(size) - size, size)
            out.append(ids[np.repeat(low, size) + np.arange(int(size.sum())) - first])
        return out

    def _in_groups(self, names: list[bytes], cells: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """``segment`` for groups of chunks of like size, so that the table of positions stays small."""
        order = sorted(range(len(names)), key=lambda i: len(names[i]))
        counts, parts, a = np.zeros(len(names), np.int64), [], 0
        while a < len(order):
            b = a + 1
            while b < len(order) and (b + 1 - a) * (len(names[order[b]]) + 1) <= cells:
                b += 1
            ids, bounds = self.segment([names[i] for i in order[a:b]])
            counts[order[a:b]] = np.diff(bounds)
            parts.append(ids)
            a = b
        # The parts lie in the order of size; each chunk knows its place in them.
        begin = np.empty(len(names), np.int64)
        ordered = np.array(order)
        begin[ordered] = np.cumsum(counts[ordered]) - counts[ordered]
        joined = np.concatenate(parts)
        bounds = np.r_[0, np.cumsum(counts)]
        size = counts
        return joined[np.repeat(begin - bounds[:-1], size) + np.arange(int(bounds[-1]))], bounds

    def decode(self, ids: list[int]) -> str:
        data = b"".join([self.bytes_of[i] for i in ids]).replace(META, b" ")
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def chunks(text: str) -> list[bytes]:
    """The text in normal form, cut before each run of blanks; empty for an empty text."""
    if not text:
        return []
    words = text.encode().replace(META, b" ").split(b" ")
    # Empty words stand for further blanks of a run, which go with the word behind them.
    out, run = [], b""
    for word in words:
        run += META
        if word:
            out.append(run + word)
            run = b""
    if run:
        out.append(run)
    return out


@lru_cache(maxsize=1)
def _automaton(model: bytes) -> Automaton:
    return Automaton(model)


def _encode(shared, text_at: int, prove: bool = False):
    def run(batches: Iterator[pa.RecordBatch]):
        automaton = _automaton(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 250):
                batch = whole.slice(at, 250)
                texts = batch.column(text_at).to_pylist()
                found = automaton.encode(texts)
                sizes = [0 if x is None else len(x) for x in found]
                offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                values = np.concatenate([x for x in found if x is not None]) if any(sizes) else np.zeros(0, np.int32)
                missing = pa.array([x is None for x in found])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=missing)
                counts = pa.array([None if x is None else len(x) for x in found], pa.int64())
                columns = {**dict(zip(batch.schema.names, batch.columns)), "ids": ids, "n_ids": counts}
                if prove:
                    del columns[batch.schema.names[text_at]]
                    again = [x is None or automaton.decode(x.tolist()) == t.replace("\u2581", " ") for x, t in zip(found, texts)]
                    columns["same"] = pa.array(again, pa.bool_())
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _decode(shared, ids_at: int):
    def run(batches: Iterator[pa.RecordBatch]):
        automaton = _automaton(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 250):
                batch = whole.slice(at, 250)
                texts = [automaton.decode(x.as_py()) if x.is_valid else None for x in batch.column(ids_at)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return run


def _with(df: DataFrame, new: list[tuple[str, T.DataType]]) -> T.StructType:
    taken = {name.lower() for name, _ in new} & {c.lower() for c in df.columns}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are there already")
    return T.StructType([*df.schema.fields, *(T.StructField(name, kind) for name, kind in new)])


def encode(df: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` and ``n_ids`` of the texts; ``model`` is the piece file's content, some hundred kilobytes."""
    schema = _with(df, [("ids", T.ArrayType(T.IntegerType())), ("n_ids", T.LongType())])
    shared = df.sparkSession.sparkContext.broadcast(model)
    return df.mapInArrow(_encode(shared, df.columns.index(text)), schema)


def decode(df: DataFrame, model: bytes, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the texts of ``ids``."""
    schema = _with(df, [("decoded", T.StringType())])
    shared = df.sparkSession.sparkContext.broadcast(model)
    return df.mapInArrow(_decode(shared, df.columns.index(ids)), schema)


def round_trip(df: DataFrame, model: bytes) -> DataFrame:
    """Per document: doc_id, ids, n_ids, and whether decoding gives the text back; one pass, ids are not sent twice."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([df.schema["doc_id"], *(T.StructField(*x) for x in (("ids", T.ArrayType(T.IntegerType())), ("n_ids", T.LongType()), ("same", T.BooleanType())))])
    return df.select("doc_id", "text").mapInArrow(_encode(shared, 1, prove=True), schema)
