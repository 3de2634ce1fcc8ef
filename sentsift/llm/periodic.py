"""Periodic run detection in the words of a text by recompression.

A run is a stretch of consecutive words with smallest period q and at least ``max(least, times * q)`` words that no
neighbouring word extends keeping the period.

1. Harmonic grid: a run of period q and ``times`` q words holds ``times`` neighbouring multiples of q, and the words
   there are equal; so are the words in between, one period apart, of which a few are probed. Over all periods the grid
   has n log n points, and nearly all fall to these comparisons.
2. Recompression: the texts with a point left are joined, a symbol of its own between every two, and compressed level by
   level. Block compression turns every maximal repetition of one symbol into a symbol; pair compression deals the
   symbols into two halves and turns each neighbouring (first half, second half) pair into a symbol. Equal pairs and
   blocks get equal names, so equal stretches are cut alike at every level but for their ends. The levels are a
   run-length grammar of the texts; their total length is about four times the text's.
3. Longest common extensions of two places walk up the levels, a symbol or block at a time, while both sides agree, and
   down again to the first difference; to the left they walk the mirrored levels. All points of a batch walk together.
   The extensions of x and x + q to both sides give the run of period q around x exactly.
4. Of the stretches found with several periods only the smallest period stays: two periods of a stretch of three or
   more times their length are multiples of the smallest.

Work and memory are O(n log n) of one text at most; a task holds one batch slice of texts. No shuffle.

Edge cases: null, empty and blank texts have no words, no runs and an empty collapsed text; one text of any length is
one piece of work; repeated rows and null ids give a row each; an empty table gives an empty result; other columns are
not read, and a column of the table called as an output column is not returned. Ties of runs: see ``strongest``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentsift.llm.segments import pieces_of, word_codes

LEAST, TIMES = 6, 4
GRID_BLOCK = 4_000_000  # grid points looked at together
_MULT = np.uint64(0x9E3779B97F4A7C15)

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _half(symbols: np.ndarray, level: int) -> np.ndarray:
    """Pseudo-random bit of each symbol, another one at each level."""
    x = (symbols.astype(np.uint64) + np.uint64(2 * level + 1)) * _MULT
    x ^= x >> np.uint64(29)
    return (x * _MULT) >> np.uint64(63) == 0


def _names(a: np.ndarray, b: np.ndarray, free: int) -> tuple[np.ndarray, int]:
    """One new symbol, from ``free`` on, for each distinct (a, b)."""
    if len(a) == 0:
        return a, free
    values, at = np.unique((a << 32) | b, return_inverse=True)
    return at + free, free + len(values)


def recompress(text: np.ndarray, fences: int) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """Levels (symbols, first): ``first[x]`` is where symbol x begins one level below, with the end as last entry.

    Symbols below ``fences`` stand once each and are never joined with others.
    """
    levels: list[tuple[np.ndarray, np.ndarray | None]] = [(text, None)]
    free, k = int(text.max()) + 1 if len(text) else 0, 0
    while True:
        s = levels[-1][0]
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        if not new.all():
            first = np.append(np.flatnonzero(new), len(s))
            size = np.diff(first)
            s = s[first[:-1]]
            long = size > 1
            s[long], free = _names(s[long], size[long], free)
            levels.append((s, first))
        inner = s >= fences
        if not (inner[1:] & inner[:-1]).any():
            return levels
        left = _half(s, k)
        k += 1
        joined = np.flatnonzero(left[:-1] & ~left[1:] & inner[:-1] & inner[1:])
        if len(joined) == 0:
            continue
        keep = np.ones(len(s), bool)
        keep[joined + 1] = False
        named, free = _names(s[joined], s[joined + 1], free)
        s = s.copy()
        s[joined] = named
        levels.append((s[keep], np.append(np.flatnonzero(keep), len(keep))))


def mirrored(levels: list) -> list:
    out, below = [], 0
    for s, first in levels:
        out.append((s[::-1], None if first is None else below - first[::-1]))
        below = len(s)
    return out


def extensions(levels: list, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Number of equal symbols from i and from j on, for each pair i <> j; fences end every extension."""
    p, q = i.copy(), j.copy()
    stopped: list[np.ndarray] = []  # of each level: the pairs whose symbols differ there
    live = np.arange(len(i))
    for k in range(len(levels) - 1):
        s, first = levels[k][0], levels[k + 1][1]
        begins = np.zeros(len(s) + 1, bool)
        begins[first] = True
        off = live[~(begins[p[live]] & begins[q[live]])]  # inside a block or pair: go on to its end
        same = s[p[off]] == s[q[off]]
        halt = [off[~same]]
        off = off[same]
        above = np.cumsum(begins) - 1
        left_p, left_q = first[above[p[off]] + 1] - p[off], first[above[q[off]] + 1] - q[off]
        step = np.minimum(left_p, left_q)
        # A pair's first symbol against a second one: their ends differ, one symbol is common.
        p[off] += step
        q[off] += step
        fits = begins[p[off]] & begins[q[off]]
        halt.append(off[~fits])
        gone = np.concatenate(halt)
        stopped.append(gone)
        if len(gone):
            alive = np.ones(len(i), bool)
            alive[gone] = False
            live = live[alive[live]]
        p[live], q[live] = above[p[live]], above[q[live]]
    top = levels[-1][0]
    more = live
    while len(more):
        more = more[top[p[more]] == top[q[more]]]
        p[more] += 1
        q[more] += 1
    done = live
    for k in range(len(levels) - 1, 0, -1):
        below, first = levels[k - 1][0], levels[k][1]
        a, b = p[done], q[done]
        x, y = first[a], first[b]
        # Symbols that differ share at most one child, or the shorter of two blocks of one symbol.
        same = below[x] == below[y]
        step = np.where(same, _common(below, x, y, first[a + 1] - x, first[b + 1] - y), 0)
        p[done], q[done] = x + step, y + step
        done = np.concatenate([done, stopped[k - 1]])
    return p - i


def _common(below, x, y, nx, ny):
    """Equal children of two different symbols with the same first child."""
    block_x = (nx > 1) & (below[x] == below[np.minimum(x + 1, len(below) - 1)])
    block_y = (ny > 1) & (below[y] == below[np.minimum(y + 1, len(below) - 1)])
    return np.where(block_x | block_y, np.minimum(np.where(block_x, nx, 1), np.where(block_y, ny, 1)), 1)


def grid_points(codes: np.ndarray, offsets: np.ndarray, times: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): multiples of a period, from the text's start, whose next ``times - 1`` multiples hold the same word."""
    n = np.diff(offsets)
    periods = np.maximum(n // times, 0)
    text = np.repeat(np.arange(len(n)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    points = np.maximum((n[text] - 1) // period - (times - 2), 0)
    ends = np.cumsum(points)
    places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    lo = 0
    while lo < len(text):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + GRID_BLOCK, side="right")))
        q = np.repeat(period[lo:hi], points[lo:hi])
        k = np.arange(len(q)) - np.repeat(np.cumsum(points[lo:hi]) - points[lo:hi], points[lo:hi])
        x = np.repeat(offsets[text[lo:hi]], points[lo:hi]) + k * q
        for step in range(1, times):
            same = codes[x] == codes[x + step * q]
            x, q = x[same], q[same]
        for inside in (1, 2):  # words in the stretch of the grid points
            probe = x + (q - 1) // inside
            same = np.ones(len(x), bool)
            for step in range(1, times - 1):
                same &= codes[probe] == codes[probe + step * q]
            x, q = x[same], q[same]
        places.append(x)
        found.append(q)
        lo = hi
    return np.concatenate(places), np.concatenate(found)


def runs_of(codes: np.ndarray, offsets: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs, by text, start and period; starts count from the text's first word."""
    x, q = grid_points(codes, offsets, times)
    if len(x) == 0:
        return (x,) * 4
    text = np.searchsorted(offsets, x, side="right") - 1
    used, text_at = np.unique(text, return_inverse=True)
    # The texts with a point left, a fence before each and one at the end.
    size = offsets[used + 1] - offsets[used]
    base = np.cumsum(size + 1) - size
    joined = np.zeros(int(base[-1] + size[-1] + 1), np.int64)
    body = np.repeat(base - offsets[used], size) + (at := _ranges(offsets[used], size))
    joined[body] = codes[at] + len(used) + 1
    fences = np.ones(len(joined), bool)
    fences[body] = False
    joined[fences] = np.arange(len(used) + 1)
    levels = recompress(joined, len(used) + 1)
    i = x - offsets[text] + base[text_at]
    right = extensions(levels, i, i + q)
    last = len(joined) - 1
    left = extensions(mirrored(levels), last - (i - 1), last - (i + q - 1))
    start, length = i - left - base[text_at], left + q + right
    good = length >= np.maximum(least, times * q)
    text, start, length, q = text[good], start[good], length[good], q[good]
    order = np.lexsort((q, length, start, text))
    text, start, length, q = text[order], start[order], length[order], q[order]
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, q = text[keep], start[keep], length[keep], q[keep]
    order = np.lexsort((q, start, text))
    return text[order], start[order], length[order], q[order]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


def _collapse(text: str | None, n: int, start, length, period) -> str:
    words = (text or "").encode().split()
    if len(start) == 0:
        return b" ".join(words).decode()
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    keep = np.cumsum(depth[:-1]) == 0
    return b" ".join([w for w, ok in zip(words, keep.tolist(), strict=True) if ok]).decode()


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
              times: int = TIMES) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): one row per row of ``docs``.

    ``runs`` lists (start, length, period) by start, then period; ``collapsed`` holds the words that no run contains
    after its first period, joined by one space. ``times`` is 3 or more.
    """
    if times < 3:
        raise ValueError("times must be 3 or more")
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, 1):
                offsets, codes = word_codes(part.column(1))
                text, start, length, period = runs_of(codes, offsets, least, times)
                cuts = np.searchsorted(text, np.arange(part.num_rows + 1))
                n = np.diff(offsets)
                collapsed = [_collapse(t, int(n[k]), start[a:b], length[a:b], period[a:b]) for k, (t, a, b) in
                             enumerate(zip(part.column(1).to_pylist(), cuts[:-1], cuts[1:], strict=True))]
                rows = pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                                                   pa.array(period, pa.int64())], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rows),
                     pa.array(collapsed, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run of greatest length / period; ties: smallest start, then smallest period. Null without runs.

    Two different quotients of texts under 30 million words differ by more than the rounding of a double.
    """
    return F.array_max(F.transform(runs, lambda r: F.struct(
        (r["length"] / r["period"]).alias("exponent"), (-r["start"]).alias("before"), (-r["period"]).alias("short"),
        r["length"].alias("length"))))
