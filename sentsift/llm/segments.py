"""Words and segments of Arrow text columns, cut on the bytes of a whole batch at once, and their stored token ids."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

BATCH_BYTES = 8 << 20


def pieces_of(batch: pa.RecordBatch, column: int, limit: int = BATCH_BYTES):
    """Slices of a batch whose text column holds about ``limit`` bytes each; a longer text stands alone."""
    column = batch.column(column)
    ends = np.cumsum(np.diff(_buffers(column)[0]))
    lo = 0
    while lo < batch.num_rows:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, bytes) of a string column; nulls hold no bytes."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        column = column.fill_null("")
    _, ends, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(ends, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    return at - at[0], np.frombuffer(data, np.uint8)[at[0]: at[-1]]


def _strings(ends: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(ends) + 1, np.int64)
    offsets[1:] = ends
    return pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def word_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, codes): the words ``[^\\x20\\x09-\\x0D]+`` of each text; equal words have equal codes, in the column only."""
    at, data = _buffers(column)
    letter = ~_IS_SPACE[data]
    new_text = np.zeros(len(data) + 1, bool)
    new_text[at] = True
    first = letter.copy()
    first[1:] &= ~letter[:-1] | new_text[1:-1]
    starts = np.flatnonzero(first)
    offsets = np.searchsorted(starts, at)
    if len(starts) == 0:
        return offsets, np.zeros(0, np.int32)
    # Bytes without the spaces lie word by word.
    sizes = np.add.reduceat(letter.astype(np.int64), starts)
    words = _strings(np.cumsum(sizes), data[letter]).dictionary_encode()
    return offsets, words.indices.to_numpy().astype(np.int64)


def cut_between(column: pa.Array, joined: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(offsets, segments): each text cut before every character whose first byte b follows a byte a with not ``joined[a, b]``."""
    at, data = _buffers(column)
    return _cut(at, data, ~joined[data[:-1], data[1:]] & (data[1:] & 0xC0 != 0x80))


def _cut(at: np.ndarray, data: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = before
    cut[at] = True
    cut[-1:] = False
    starts = np.flatnonzero(cut)
    return np.searchsorted(starts, at), _strings(np.append(starts[1:], len(data)) if len(starts) else starts, data)


class SegmentStore:
    """Ids of the segments that a worker met so far; it forgets all of them beyond ``limit`` segments."""

    def __init__(self, encode, limit: int):
        self.encode, self.limit = encode, limit  # encode: list of texts -> list of id lists
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ends = np.zeros(1, np.int64)  # of each stored segment's ids in ``flat``
        self.flat = np.zeros(0, np.uint32)

    def _add(self, lists: list) -> np.ndarray:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        first = len(self.ends) - 1
        self.flat = np.concatenate([self.flat, np.fromiter(itertools.chain.from_iterable(lists), np.uint32, int(sizes.sum()))])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        return np.arange(first, first + len(lists))

    def _numbers(self, texts: list[str]) -> np.ndarray:
        if len(self.number) > self.limit:
            self.clear()
        new = [t for t in texts if t not in self.number]
        self.number.update(zip(new, self._add(self.encode(new)).tolist(), strict=True))
        return np.fromiter(map(self.number.__getitem__, texts), np.int64, len(texts))

    def lay_out(self, at: np.ndarray, parts: pa.Array, whole: np.ndarray, rest: list) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of texts cut into ``parts`` at ``at``; texts marked in ``whole`` have no parts but the ids in ``rest``.

        Each different part is encoded once; the ids are laid out by array operations.
        """
        coded = parts.dictionary_encode()
        code = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        kept = len(self.ends), len(self.flat)
        if len(rest):  # stand between the segments of the others and are not kept
            code = np.insert(code, at[np.flatnonzero(whole)], self._add(rest))
            at = at + np.append(0, np.cumsum(whole))
        taken = pa.LargeListArray.from_arrays(pa.array(self.ends), pa.array(self.flat)).take(pa.array(code))
        ends = taken.offsets.to_numpy()
        self.ends, self.flat = self.ends[:kept[0]], self.flat[:kept[1]]
        return (ends - ends[0])[at], taken.flatten().to_numpy()
