"""Packing of tokenised texts into sequences of one capacity by Karmarkar-Karp multiway differencing.

1. Every text becomes its token ids and an end id. Texts are cut before each space that follows another character, and
   before each sign that follows a letter or digit; the tokenizer never joins tokens across such a place, so each distinct
   segment of a batch is encoded once, and the ids are laid out by array operations. Texts with other white space than
   ASCII's or with a special token's string are encoded whole.
2. As long as a text fills whole sequences, it does so alone. What is left of each text is an item.
3. Items are dealt at random (by a hash of their row in the stored table) to groups of about ``WINDOWS`` sequences, so no
   task holds more than one group, whatever the lengths, ids or copies of the texts.
4. Differencing in a group: every item starts as a partial partition of one filled window and empty ones. The two
   partial partitions of largest imbalance (fullest less emptiest window) are merged, the fullest window of one with the
   emptiest of the other, until one partition is left: its windows are near-equal. It starts with as few windows as the
   tokens need; whenever a window exceeds the capacity, the number of windows rises.
5. Levelling: the emptiest windows are dissolved again and their pieces fill the others up, cut where a window is full,
   until as few windows as possible are left. The last, partly filled one is cut into powers of two, which need no padding.

Edge cases: null and empty texts are the end id alone; a text of any length is cut freely; repeated rows and null ids are
packed like all others, each row by itself; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentsift.llm.common import cut
from sentsift.llm.segments import SegmentStore, cut_between, pieces_of

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
WINDOWS = 128
BATCH_BYTES = 12 << 20
MEMO = 1_200_000  # a worker forgets its segments beyond this number
END = 0
#: White space that the tokenizer knows beside ASCII's; next to it, a cut could change the tokens.
OTHER_SPACE = "[\\x1c-\\x1f\\x85\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def _joined() -> np.ndarray:
    """[a, b]: whether byte b may stand in one token after byte a."""
    b = np.arange(256)
    space = (b == 32) | (b >= 9) & (b <= 13)
    word = (b >= 48) & (b < 58) | (b >= 65) & (b < 91) | (b >= 97) & (b < 123)
    sign = (b > 32) & (b < 127) & ~word
    return ~(~space[:, None] & space) & ~(word[:, None] & sign)


JOINED = _joined()


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """The tokenizer of a worker and a bounded store of the ids of the segments met so far."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallel parts
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.store = SegmentStore(self._encode, MEMO)
        special = (re.escape(t.content) for t in self.model.get_added_tokens_decoder().values())
        self.whole = "|".join([OTHER_SPACE, *special])  # texts with a special token's string are not cut either

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts of a column; nulls have none."""
        column = column.fill_null("")
        whole = pc.match_substring_regex(column, self.whole).to_numpy(zero_copy_only=False)
        rest = self._encode(column.filter(pa.array(whole)).to_pylist())
        at, parts = cut_between(pc.if_else(pa.array(whole), "", column) if len(rest) else column, JOINED)
        return self.store.lay_out(at, parts, whole, rest)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _whole_and_rest(path: str, capacity: int):
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, ids) of each text: whole sequences, then the rest with its ids."""
    def run(batches):
        encoder = _encoder(path)
        for batch in batches:
            for part in pieces_of(batch, 1, BATCH_BYTES):
                ends, flat = encoder.encode(part.column(1))
                row, start, length, crc, total, ids = [], [], [], [], [], []
                for k in range(part.num_rows):
                    own = np.append(flat[ends[k]: ends[k + 1]], np.uint32(END)).astype("<u4").tobytes()
                    n = len(own) // 4
                    for lo in range(0, n, capacity):
                        piece = own[4 * lo: 4 * (lo + capacity)]
                        full = len(piece) == 4 * capacity
                        row.append(k)
                        start.append(lo)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece) if full else None)
                        total.append(n)
                        ids.append(None if full else piece)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64()), pa.array(total, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
    return run


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: item numbers of each of ``windows`` windows with near-equal sums."""
    # A partial partition: its windows from the fullest to the emptiest filled one, as (sum, tree of items). Sums are
    # less that of the emptiest window, which the heap's imbalance does not need.
    heap = [(-n, k, [(n, k)]) for k, n in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        alone = windows - len(b)  # so many of a's windows meet an empty one of b
        if alone >= len(a):
            merged = a + b
        else:
            # The fullest windows of a meet b's empty ones, the others b's from the emptiest on.
            merged = a[:alone] + [(x + y, (s, t)) for (x, s), (y, t) in zip(a[alone:], reversed(b), strict=False)]
            merged += b[: len(b) - (len(a) - alone)]
        merged.sort(key=lambda w: -w[0])
        if len(merged) == windows and merged[-1][0] > 0:
            low = merged[-1][0]
            merged = [(n - low, t) for n, t in merged]
        count += 1
        heapq.heappush(heap, (-(merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)), count, merged))
    return [_leaves(tree) for _, tree in heap[0][2]] if heap else []


def _leaves(tree) -> list[int]:
    out, stack = [], [tree]
    while stack:
        t = stack.pop()
        if isinstance(t, tuple):
            stack += t
        else:
            out.append(t)
    return sorted(out)


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of whole items, none above ``capacity``; their number rises until that holds."""
    total = sum(sizes)
    count = -(-total // capacity)
    while True:
        found = difference(sizes, count)
        excess = max((sum(sizes[i] for i in w) for w in found), default=0) - capacity
        if excess <= 0:
            return found
        # The fullest window stands so much above the mean; with this number the mean leaves room for it.
        above = capacity + excess - total / count
        count = max(count + 1, min(int(total / max(capacity - above, 1)), count + max(1, count // 8)))


def level(sizes: list[int], found: list[list[int]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (item, from, to): the emptiest windows fill up the others; the last is cut into powers of two."""
    sums = [sum(sizes[i] for i in w) for w in found]
    order = sorted(range(len(found)), key=lambda w: (-sums[w], w))
    needed = -(-sum(sums) // capacity)
    kept = [[(i, 0, sizes[i]) for i in found[w]] for w in order[:needed]]
    room = [capacity - sums[w] for w in order[:needed]]
    loose = [(i, 0, sizes[i]) for w in order[needed:] for i in found[w]]
    at = 0
    for i, lo, hi in loose:
        while lo < hi:
            while room[at] == 0:
                at += 1
            step = min(room[at], hi - lo)
            kept[at].append((i, lo, lo + step))
            room[at] -= step
            lo += step
    # Several windows may have room left: all from the first of them on are made full in turn, the last keeps the rest.
    gaps = [w for w in range(len(kept)) if room[w]]
    while len(gaps) > 1:
        first, last = gaps[0], gaps[-1]
        i, lo, hi = kept[last].pop()
        step = min(room[first], hi - lo)
        kept[first].append((i, hi - step, hi))
        if hi - step > lo:
            kept[last].append((i, lo, hi - step))
        room[first] -= step
        room[last] += step
        gaps = [w for w in gaps if room[w] and kept[w]]
    kept = [w for w in kept if w]
    out = [w for w in kept if sum(hi - lo for _, lo, hi in w) == capacity]
    for w in kept:
        rest = sum(hi - lo for _, lo, hi in w)
        if rest == capacity:
            continue
        queue = list(w)
        while rest:
            size = 1 << (rest.bit_length() - 1)
            rest -= size
            part: list[tuple[int, int, int]] = []
            while size:
                i, lo, hi = queue.pop(0)
                step = min(size, hi - lo)
                part.append((i, lo, lo + step))
                size -= step
                if lo + step < hi:
                    queue.insert(0, (i, lo + step, hi))
            out.append(part)
    return out


def _packed(capacity: int):
    def run(key, table):
        table = table.sort_by("row")
        rows = table.select(["start", "length", "doc_tokens", "ids"]).to_pylist()
        sizes = [r["length"] for r in rows]
        item, start, length, crc, total, number, offset = [], [], [], [], [], [], []
        for k, window in enumerate(level(sizes, windows_of(sizes, capacity), capacity)):
            at = 0
            for i, lo, hi in window:
                r = rows[i]
                item.append(i)
                start.append(r["start"] + lo)
                length.append(hi - lo)
                crc.append(zlib.crc32(r["ids"][4 * lo: 4 * hi]))
                total.append(r["doc_tokens"])
                number.append((key[0].as_py() << 33) + 2 * k + 1)
                offset.append(at)
                at += hi - lo
        long = lambda x: pa.array(x, pa.int64())
        return pa.table([table.column("doc_id").take(long(item)), long(start), long(length), long(crc), long(total),
                         long(number), long(offset)],
                        names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         path: str | None = None, windows: int = WINDOWS) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Pieces of a sequence lie gapless from offset 0. Sequences hold ``capacity`` tokens, or a power of two below it.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    pieces = cut(source.mapInArrow(_whole_and_rest(path or tokenizer_path(), capacity),
                                   f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, ids binary")
                 .withColumn("row", F.monotonically_increasing_id()), "op13pieces")
    rest = pieces.filter("ids is not null")
    tokens = rest.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-tokens // (windows * capacity)))
    packed = (rest.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
              .select("group", "row", "doc_id", "start", "length", "doc_tokens", "ids").groupBy("group")
              .applyInArrow(_packed(capacity), f"doc_id {kind}, start long, length long, ids_crc32 long, "
                            "doc_tokens long, sequence_id long, offset long"))
    # Even numbers: whole sequences of one text, by their row in the stored table; odd ones: group and window.
    alone = pieces.filter("ids is null").select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return alone.unionByName(packed)
