"""SentencePiece encoding and decoding by a streaming Viterbi search over a given vocabulary.

The search keeps a window: scores and backpointers from the last committed boundary to the furthest piece end. Ids are
committed whenever every surviving path runs through one boundary: at once where no piece crosses it, and otherwise
by following the backpointers of all live ends to their common ancestor, tried once per longest piece.

Between two characters that stand together in no piece is always such a boundary, so the ids of the stretches in between
do not depend on their surroundings: a batch is cut there on its bytes, each different stretch is searched once, and the
ids are laid out by array operations. A bounded store per task keeps the ids of stretches met before.

Scores come from the model file. A BPE file holds merge ranks instead of log probabilities; they become Zipf
log probabilities, log(1 / ((rank + 2) H)). Characters without a piece cost the lowest score - 10 and are written as
byte pieces, or as the unknown id where the vocabulary has no bytes. Space signs that stand in a text literally are
written as byte pieces too, so decoding is exact. Nothing is trained here.

Edge cases: null text gives null ids and back; empty text gives an empty list; texts of any length stream; repeated rows
encode alike; no shuffle, so hot keys and extra columns do not matter; an empty table gives an empty result; ids
outside the vocabulary decode to nothing, bytes that are no UTF-8 to replacement signs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from sentsift.llm.common import tidy
from sentsift.llm.segments import SegmentStore, cut_between, pieces_of

SPACE = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_COST = 10.0
BATCH_BYTES = 1 << 20
MEMO = 200_000  # stretches whose ids a task keeps
_END = 0  # trie key of a piece end; other keys are characters


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with log probabilities; bounded by the tokenizer file, so it is shipped to every task."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]  # id of every byte value, or empty
    unknown: int
    normal: tuple[bool, ...]


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    normal = tuple(not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i)) for i in range(n))
    byte = {int(m.id_to_piece(i)[1:-1], 16): i for i in range(n) if m.is_byte(i)}
    scores = [m.get_score(i) for i in range(n)]
    real = [s for s, ok in zip(scores, normal, strict=True) if ok]
    if all(a - b == 1 for a, b in zip(real, real[1:], strict=False)):  # merge ranks
        total = math.log(sum(1 / (r + 2) for r in range(len(real))))
        zipf = iter(-math.log(r + 2) - total for r in range(len(real)))
        scores = [next(zipf) if ok else 0.0 for ok in normal]
    return Vocabulary(tuple(m.id_to_piece(i) for i in range(n)), tuple(scores),
                      tuple(byte[b] for b in range(256)) if len(byte) == 256 else (), m.unk_id(), normal)


class Codec:
    """Encoder and decoder of one vocabulary, with the trie and the memo of a worker."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.root: dict = {}
        self.longest = 1
        #: Whether some piece holds a character that ends in byte a before one that begins with byte b.
        self.joined = np.zeros((256, 256), bool)
        for i, (p, s, ok) in enumerate(zip(v.pieces, v.scores, v.normal, strict=True)):
            if ok and p:
                node = self.root
                for c in p:
                    node = node.setdefault(c, {})
                node[_END] = (i, s)
                self.longest = max(self.longest, len(p))
                for a, b in zip(p, p[1:], strict=False):
                    self.joined[_bytes(a)[-1], _bytes(b)[0]] = True
        self.cost = min((s for s, ok in zip(v.scores, v.normal, strict=True) if ok), default=0.0) - UNKNOWN_COST
        self.store = SegmentStore(lambda texts: [list(self._ids(t.replace(" ", SPACE))) for t in texts], MEMO)
        raw = {b: bytes([k]) for k, b in enumerate(v.byte_ids)}
        self.bytes = [raw.get(i, p.replace(SPACE, " ").encode() if ok else b"")
                      for i, (p, ok) in enumerate(zip(v.pieces, v.normal, strict=True))]
        self.table = pa.array([*self.bytes, b""], pa.large_binary())  # the last entry for ids outside the vocabulary

    def _spell(self, c: str) -> list[int]:
        return [self.v.byte_ids[b] for b in c.encode()] if self.v.byte_ids else [self.v.unknown]

    def stream(self, text: str):
        """Yields the ids of ``text`` in committed runs; memory is the window, not the text."""
        root, n, cost = self.root, len(text), self.cost
        base, reach = 0, 0
        best, back = {0: 0.0}, {}
        tried = 0
        for i in range(n):
            if reach <= i and i > base:  # no piece crosses i
                yield self._trace(back, base, i, text)
                base, best, back = i, {i: 0.0}, {}
            elif i - base >= self.longest and i - tried >= self.longest:
                tried = i
                common = self._common(back, [q for q in best if q >= i], base)
                if common > base:
                    yield self._trace(back, base, common, text)
                    base = common
                for q in [q for q in best if q < i]:
                    del best[q]
                for q in [q for q in back if q <= base]:
                    del back[q]
            if i not in best:
                continue
            here, node, j, single = best[i], root, i, False
            while j < n:
                node = node.get(text[j])
                if node is None:
                    break
                j += 1
                end = node.get(_END)
                if end is not None:
                    single |= j == i + 1
                    total = here + end[1]
                    if j not in best or total > best[j]:
                        best[j], back[j] = total, (i, end[0])
                    if j > reach:
                        reach = j
            if not single:
                total = here + cost
                if i + 1 not in best or total > best[i + 1]:
                    best[i + 1], back[i + 1] = total, (i, -1)
                reach = max(reach, i + 1)
        if n:
            yield self._trace(back, base, n, text)

    @staticmethod
    def _common(back: dict, ends: list[int], base: int) -> int:
        live = set(ends)
        while len(live) > 1:
            q = max(live)
            live.remove(q)
            live.add(back[q][0] if q > base else base)
        return live.pop() if live else base

    def _trace(self, back: dict, base: int, end: int, text: str) -> list[int]:
        out: list[list[int]] = []
        while end > base:
            start, piece = back[end]
            out.append([piece] if piece >= 0 else self._spell(text[start]))
            end = start
        return [i for ids in reversed(out) for i in ids]

    def _ids(self, s: str):
        return (i for run in self.stream(s) for i in run)

    def _literal(self, text: str) -> list[int]:
        """Ids of a text with space signs of its own."""
        out: list[int] = []
        for k, part in enumerate(text.split(SPACE)):
            s = part.replace(" ", SPACE)
            if k:
                out += self._spell(SPACE)
            else:
                s = SPACE + s
            out += self._ids(s)
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts of a column; nulls have none."""
        column = column.fill_null("")
        whole = pc.match_substring(column, SPACE).to_numpy(zero_copy_only=False)
        rest = [self._literal(t) for t in column.filter(pa.array(whole)).to_pylist()]
        led = pc.if_else(pc.or_(pa.array(whole), pc.equal(column, "")), "", pc.binary_join_element_wise(" ", column, ""))
        at, parts = cut_between(led, self.joined)
        return self.store.lay_out(at, parts, whole, rest)

    def decode(self, ids: list[int]) -> str:
        table, n = self.bytes, len(self.bytes)
        text = b"".join([table[i] for i in ids if 0 <= i < n]).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text

    def decode_all(self, lists: pa.ListArray) -> pa.Array:
        """The texts of a column of id lists: the bytes of all ids at once, ended row by row; nulls have none."""
        n = len(self.bytes)
        ids = lists.flatten().cast(pa.int64()).fill_null(n).to_numpy(zero_copy_only=False)
        parts = self.table.take(pa.array(np.where((ids >= 0) & (ids < n), ids, n)))
        rows = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
        _, ends, data = parts.buffers()
        ends = np.frombuffer(ends, np.int64)[parts.offset:][rows] if len(ids) else np.zeros(len(rows), np.int64)
        data = np.frombuffer(data, np.uint8)[: ends[-1]] if data is not None else np.zeros(0, np.uint8)
        led = ends[:-1] < ends[1:]
        led[led] = data[ends[:-1][led]] == ord(" ")
        data, ends = np.delete(data, ends[:-1][led]), ends - np.append(0, np.cumsum(led))
        texts = pa.LargeStringArray.from_buffers(len(lists), pa.py_buffer(ends), pa.py_buffer(data))
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:  # some text is no UTF-8
            return pa.array([None if x is None else self.decode([i for i in x if i is not None]) for x in lists.to_pylist()],
                            pa.string())
        return pc.if_else(lists.is_valid(), texts.cast(pa.string()), pa.scalar(None, pa.string()))


def _bytes(c: str) -> bytes:
    return (" " if c == SPACE else c).encode()


_CODECS: dict[int, Codec] = {}


def codec(v: Vocabulary) -> Codec:
    """The worker's codec; reused between tasks, without what it stored."""
    key = hash(v)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(v)
    return _CODECS[key]


def _append(batch: pa.RecordBatch, column: pa.Array, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def encode(docs: DataFrame, text_col: str = "text", out_col: str = "ids", vocabulary: Vocabulary | None = None,
           path: str = MODEL) -> DataFrame:
    """``docs`` with ``out_col`` array<int>: the ids of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or load_vocabulary(path))

    def run(batches):
        c = codec(shared.value)
        try:
            for batch in batches:
                at = batch.schema.names.index(text_col)
                for part in pieces_of(batch, at, BATCH_BYTES):
                    ends, flat = c.encode(part.column(at))
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32)),
                                                     mask=part.column(at).is_null())
                    yield _append(part, lists, out_col)
        finally:
            c.store.clear()  # the worker lives on in later stages

    columns = [F.col(f"`{c}`") for c in docs.columns if c != out_col]
    source = docs.select(*columns)
    schema = StructType([*source.schema.fields]).add(out_col, ArrayType(IntegerType()))
    return source.mapInArrow(tidy(run), schema)


def decode(docs: DataFrame, ids_col: str = "ids", out_col: str = "decoded", vocabulary: Vocabulary | None = None,
           path: str = MODEL) -> DataFrame:
    """``docs`` with ``out_col`` string: the text of the ids."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or load_vocabulary(path))

    def run(batches):
        c = codec(shared.value)
        for batch in batches:
            at = batch.schema.names.index(ids_col)
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                yield _append(part, c.decode_all(part.column(at)), out_col)

    columns = [F.col(f"`{c}`") for c in docs.columns if c != out_col]
    source = docs.select(*columns)
    return source.mapInArrow(tidy(run), StructType([*source.schema.fields]).add(out_col, StringType()))
