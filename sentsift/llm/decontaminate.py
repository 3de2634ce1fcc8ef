"""Benchmark decontamination by latent semantic retrieval.

1. Every text becomes a list of 32-bit word hashes (letter and digit runs, lower case), stored once in the shared
   folder; the low ``TERM_BITS`` bits are its hashed terms.
2. Document frequencies over all passages (blocks of ``PASSAGE`` words), as sums per task that Spark adds up.
3. Randomised SVD of the passages' TF-IDF matrix A, distributed: every task adds its part of A'(A R) for a Gaussian R of
   rank + ``OVERSAMPLE`` columns; the sums have the size of the hashed vocabulary, not of the corpus. A Nystroem step gives
   the leading right singular vectors. Term vectors are whitened by the singular values, centred and set to idf length, so
   that the frequent words of the leading directions do not drown the rest.
4. Candidate search: cosine of every window, three sizes with half overlap, to every item of its size class, in blocks
   of items; windows are differences of running sums, so a text is read once whatever the window sizes. Items of
   which a text lacks so many words that step 5 must fail are not searched in it. Beside it, stretches of ``SEED_WORDS`` words
   (fewer for short items) that stand in the item too: a verbatim excerpt long enough for step 5 holds one, however
   little its surroundings resemble the item. Pairs found that way may have a cosine below the threshold.
5. A candidate is confirmed on its stretch of the text: the longest common subsequence must cover ``LCS_SHARE`` of
   the item's words and, if the benchmark has an answer column, ``ANSWER_SHARE`` of the answer's words; ``answer`` is null
   without one.

Edge cases: null and empty texts and items match nothing; items under ``SHORT_ITEM`` words must stand in the text whole and
in one piece, as any text holds most of their words by chance; copies are all found; texts of any length are searched whole; null ids are kept apart by
row and never dropped by ``drop_contaminated``; extra columns are kept; empty tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentsift.llm.common import cut, tidy

TERM_BITS, RANK, OVERSAMPLE, PASSAGE = 14, 48, 8, 32
SIZES = (16, 32, 56)  # windows for items under 24, under 48, and longer
COSINE, LCS_SHARE, ANSWER_SHARE, SHORT_ITEM = 0.4, 0.6, 0.5, 8
SEED_WORDS = 8
ITEM_BLOCK = 2048
STEP = 2048  # words taken at a time
BLOCK = 128  # passages whose rows are added up by term at a time
UNIT = 4  # divides every window size and half of it
CELLS = 1 << 22  # item by word table of the search
SEED = 11
_MULT = np.uint64(0x9E3779B97F4A7C15)
FOUND = "doc_id long, item_id long, cosine double, lcs double, answer double, at int"


def word_ids(text: Column) -> Column:
    w = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(w, lambda x: x != ""), lambda x: F.hash(x))


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], column.flatten().to_numpy(zero_copy_only=False)


def _terms(flat: np.ndarray) -> np.ndarray:
    return flat & ((1 << TERM_BITS) - 1)


def _passages(offsets: np.ndarray) -> np.ndarray:
    """Passage number of every word."""
    n = np.diff(offsets)
    inside = np.arange(offsets[-1]) - np.repeat(offsets[:-1], n)
    per = -(-n // PASSAGE)
    return np.repeat(np.cumsum(per) - per, n) + inside // PASSAGE


def _frequencies(batches):
    df = np.zeros(1 << TERM_BITS, np.int64)
    total = 0
    for batch in batches:
        offsets, flat = _flat(batch.column(0))
        if len(flat):
            at = _passages(offsets)
            total += int(at[-1]) + 1
            terms = _terms(flat)
            for lo in range(0, int(at[-1]) + 1, 1024):  # passage and term in one number, counted once
                a, b = np.searchsorted(at, (lo, lo + 1024))
                code = np.sort(((at[a:b] - lo) << TERM_BITS).astype(np.int32) | terms[a:b])
                once = code[np.r_[True, code[1:] != code[:-1]]]
                df += np.bincount(_terms(once), minlength=len(df))
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(df[some], total))],
                                     names=["term", "df"])


def _sums_by_term(terms: np.ndarray, at: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms and, for each, the sum of the rows of y of its passages, as a product of counts."""
    row = np.zeros(1 << TERM_BITS, np.int64)
    row[terms] = 1
    once = np.flatnonzero(row)
    row[once] = np.arange(len(once)) * len(y)
    counts = np.bincount(row[terms] + at, minlength=len(once) * len(y))
    return once, counts.astype(np.float32).reshape(len(once), len(y)) @ y


def _range_part(idf: np.ndarray):
    """A'(A R) of a task's passages, one row per term."""
    def run(batches):
        test = np.random.default_rng(SEED).standard_normal((1 << TERM_BITS, RANK + OVERSAMPLE)).astype(np.float32)
        test = np.vstack([test * idf[:, None], np.zeros((1, test.shape[1]), np.float32)])
        out = np.zeros((1 << TERM_BITS, RANK + OVERSAMPLE), np.float32)
        used = np.zeros(1 << TERM_BITS, bool)
        for batch in batches:
            offsets, flat = _flat(batch.column(0))
            cuts = np.searchsorted(offsets, np.arange(0, offsets[-1] + STEP, STEP))
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                t = _terms(flat[offsets[lo]: offsets[min(hi, len(offsets) - 1)]])
                if not len(t):
                    continue
                at = _passages(offsets[lo: min(hi, len(offsets) - 1) + 1] - offsets[lo])
                first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                grid = np.full((len(first), PASSAGE), 1 << TERM_BITS)  # short passages end in the zero row
                grid[at, np.arange(len(t)) - first[at]] = t
                y = test[grid].sum(axis=1)
                norm = np.add.reduceat(idf[t] ** 2, first)
                y /= np.maximum(norm, 1e-9)[:, None]
                ends = np.append(first, len(t))
                for p in range(0, len(first), BLOCK):
                    a, b = ends[p], ends[min(p + BLOCK, len(first))]
                    once, sums = _sums_by_term(t[a:b], at[a:b] - p, y[p: p + BLOCK])
                    out[once] += sums
                    used[once] = True
        some = np.flatnonzero(used)
        rows = (out[some] * idf[some, None]).astype(np.float32)
        for i in range(0, len(some), 4096):
            part = rows[i: i + 4096]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some[i: i + 4096]), pa.array([p.tobytes() for p in part], pa.binary())], names=["term", "z"])
    return run


def _add_up(frames):
    """Sums the parts of each term in a partition; holds one row per term of the partition."""
    import pandas as pd
    total: dict[int, np.ndarray] = {}
    for f in frames:
        for term, z in zip(f["term"], f["z"], strict=True):
            v = np.frombuffer(z, np.float32).astype(np.float64)
            if term in total:
                total[term] += v
            else:
                total[term] = v
    yield pd.DataFrame({"term": list(total), "z": [v.astype(np.float32).tobytes() for v in total.values()]})


@dataclass
class LatentSpace:
    vectors: np.ndarray   # (terms, RANK) term vectors of idf length
    singular: np.ndarray  # leading singular values of A

    def embed(self, terms: np.ndarray) -> np.ndarray:
        v = self.vectors[terms].sum(axis=0)
        return v / max(float(np.linalg.norm(v)), 1e-12)


def fit_space(ids: DataFrame) -> LatentSpace:
    """Randomised SVD over all rows of ``ids`` (array<int> column ``ids``); the driver gets vocabulary-sized sums."""
    spark = ids.sparkSession
    size = 1 << TERM_BITS
    counts = (ids.select("ids").mapInArrow(tidy(_frequencies), "term long, df long").groupBy("term")
              .agg(F.sum("df").alias("df")).collect())
    df = np.zeros(size)
    for r in counts:
        if r.term >= 0:
            df[r.term] = r.df
    passages = max([r.df for r in counts if r.term < 0], default=0)
    idf = np.log((passages + 1) / (df + 1)).astype(np.float32)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (ids.select("ids").mapInArrow(tidy(_range_part(idf)), "term long, z binary").repartition(parts, "term")
            .mapInPandas(_add_up, "term long, z binary").collect())
    z = np.zeros((size, RANK + OVERSAMPLE))
    for r in rows:
        z[r.term] += np.frombuffer(r.z, np.float32)
    test = np.random.default_rng(SEED).standard_normal((size, RANK + OVERSAMPLE))
    small = test.T @ z
    value, vector = np.linalg.eigh((small + small.T) / 2)
    value = np.maximum(value, 1e-9 * max(value.max(initial=0), 1e-30))
    left, sigma, _ = np.linalg.svd(z @ (vector / np.sqrt(value)), full_matrices=False)
    sigma = np.maximum(sigma[:RANK], 1e-12)
    terms = left[:, :RANK] / sigma
    terms -= terms[df > 0].mean(axis=0) if (df > 0).any() else 0
    terms /= np.maximum(np.linalg.norm(terms, axis=1, keepdims=True), 1e-12)
    return LatentSpace((terms * idf[:, None]).astype(np.float32), sigma)


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & where.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _enough(terms, rows, items, start, stop, may, has, length):
    """Of the (window, item) pairs those whose surroundings hold enough words of the item for ``LCS_SHARE`` of it.

    Running counts over the text, one for each item met, give the count of every window at once.
    """
    met, at = np.unique(items, return_inverse=True)
    held = np.zeros(len(rows), np.int64)
    step = max(1, CELLS // max(1, len(terms)))
    for k in range(0, len(met), step):
        here = may[met[k: k + step]]
        count = np.zeros((len(here), len(terms) + 1), np.int32)
        np.cumsum(has[here][:, terms], axis=1, out=count[:, 1:])
        own = np.flatnonzero((at >= k) & (at < k + step)) if len(met) > step else slice(None)
        half = length[may[items[own]]] // 2
        lo = np.maximum(start[rows[own]] - half, 0)
        hi = np.minimum(stop[rows[own]] + half, len(terms))
        held[own] = count[at[own] - k, hi] - count[at[own] - k, lo]
    keep = held >= LCS_SHARE * length[may[items]]
    return rows[keep], items[keep]


def _grams(flat: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every stretch of k words."""
    x = flat.astype(np.int64).view(np.uint64)
    n = max(0, len(x) - k + 1)
    h = x[:n].copy()
    for j in range(1, k):
        h = h * _MULT + x[j: n + j]
    return (h ^ (h >> np.uint64(31))) * _MULT


def _seed_tables(items) -> list[tuple]:
    """Per stretch length k: sorted hashes of the items' stretches, their item and place, and a table of leading bits."""
    by_k: dict[int, list] = {}
    for r, (_, w, _) in enumerate(items):
        k = len(w) if len(w) < SHORT_ITEM else min(SEED_WORDS, int(np.ceil(LCS_SHARE * len(w) - 1e-9)))
        by_k.setdefault(k, []).append((r, np.asarray(w, np.int32)))
    out = []
    for k, own in sorted(by_k.items()):
        grams = [_grams(w, k) for _, w in own]
        h = np.concatenate(grams)
        row = np.repeat([r for r, _ in own], [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(h, kind="stable")
        lead = np.zeros(1 << 18, bool)
        lead[h >> np.uint64(46)] = True
        out.append((k, h[order], row[order], place[order], lead))
    return out


def _seeded(tables, offsets: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Distinct (text, item row, place in the text where the item would begin) of equal stretches."""
    out = [np.zeros((0, 3), np.int64)]
    for k, h, row, place, lead in tables:
        g = _grams(flat, k)
        at = np.flatnonzero(lead[g >> np.uint64(46)])
        d = np.searchsorted(offsets, at, "right") - 1
        inside = at + k <= offsets[d + 1]
        at, d = at[inside], d[inside]
        lo, hi = np.searchsorted(h, g[at], "left"), np.searchsorted(h, g[at], "right")
        n = hi - lo
        hit = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out.append(np.unique(np.stack([np.repeat(d, n), row[hit], np.repeat(at - offsets[d], n) - place[hit]], axis=1), axis=0))
    return np.concatenate(out)


class _Items:
    """The items of one size class: their vectors and words."""

    def __init__(self, space: LatentSpace, own: list):
        self.own = own
        self.q = np.stack([space.embed(_terms(w)) for _, w, _ in own]).astype(np.float32)
        self.length = np.array([len(w) for _, w, _ in own])
        self.least = LCS_SHARE * self.length
        self.grid = np.full((len(own), int(self.length.max())), 1 << TERM_BITS)  # the last slot is never present
        self.has = np.zeros((len(own), 1 << TERM_BITS), bool)
        for r, (_, w, _) in enumerate(own):
            self.grid[r, : len(w)] = _terms(w)
            self.has[r, _terms(w)] = True


class _RareWords:
    """An inverted list of the rarest words of all items.

    An item of which a text holds ``LCS_SHARE`` has at least one of any share above the rest there; so its rarest words, as
    many as may be missing and one more, lead to every item that can be found, in one pass over the words of a batch.
    """

    def __init__(self, space: LatentSpace, classes: list[_Items]):
        rarity = np.linalg.norm(space.vectors, axis=1)  # idf
        term, item = [], []
        self.place = []  # class and number there of each item
        for k, c in enumerate(classes):
            for r, (_, w, _) in enumerate(c.own):
                t = _terms(w)
                rare = np.unique(t[np.argsort(-rarity[t], kind="stable")][: len(t) - int(np.ceil(c.least[r] - 1e-9)) + 1])
                term.append(rare)
                item.append(np.full(len(rare), len(self.place)))
                self.place.append((k, r))
        self.place = np.array(self.place, np.int64).reshape(-1, 2)
        term = np.concatenate(term) if term else np.zeros(0, np.int64)
        order = np.argsort(term, kind="stable")
        self.item = np.concatenate(item)[order] if item else np.zeros(0, np.int64)
        self.ends = np.searchsorted(term[order], np.arange((1 << TERM_BITS) + 1))
        self.known = self.ends[1:] > self.ends[:-1]

    def candidates(self, offsets: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ends, classes, numbers): the items that a word of each text leads to, text by text."""
        terms = _terms(flat)
        at = np.flatnonzero(self.known[terms])
        t = terms[at]
        first, size = self.ends[t], self.ends[t + 1] - self.ends[t]
        text = np.searchsorted(offsets, at, "right") - 1
        met = self.item[np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)]
        code = np.unique(np.repeat(text, size) * max(1, len(self.place)) + met)
        ends = np.searchsorted(code, np.arange(len(offsets)) * max(1, len(self.place)))
        kind, number = self.place[code % max(1, len(self.place))].T if len(code) else (code, code)
        return ends, kind, number


def _running_sums(vectors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Sums of the vectors of the first 0, 1, 2, ... ``UNIT`` terms; the last row of ``vectors`` is zero."""
    grid = np.full(-(-len(terms) // UNIT) * UNIT, len(vectors) - 1)
    grid[: len(terms)] = terms
    grid = grid.reshape(-1, UNIT)
    part = vectors[grid[:, 0]]
    for j in range(1, UNIT):
        part += vectors[grid[:, j]]
    sums = np.zeros((len(part) + 1, vectors.shape[1]), np.float32)
    np.cumsum(part, axis=0, out=sums[1:])
    return sums


def _search(space, items, threshold: float):
    """items: (item_id, word hashes, answer hashes)."""
    def run(batches):
        s = space.value
        tables = _seed_tables(items.value)
        classes = []
        for k, size in enumerate(SIZES):
            lo, hi = (0, 24, 48)[k], (24, 48, 1 << 30)[k]
            own = [(i, np.asarray(w, np.int32), list(a)) for i, w, a in items.value if max(lo, SHORT_ITEM) <= len(w) < hi]
            if own:
                classes.append((size, _Items(s, own)))
        rare = _RareWords(s, [c for _, c in classes])
        vectors = np.vstack([s.vectors, np.zeros((1, RANK), np.float32)])  # texts end in the zero row
        for batch in batches:
            offsets, flat = _flat(batch.column(1))
            ids = batch.column(0).to_pylist()
            best: dict[tuple, tuple] = {}

            def confirm(d, words, start, stop, item, w, answer, cosine):
                if len(w) < SHORT_ITEM and not np.array_equal(words[start:stop], w):
                    return
                half = len(w) // 2 if len(w) >= SHORT_ITEM else len(w) // 2 + len(answer)
                near = words[max(0, start - half): stop + half].tolist()
                share = lcs(w.tolist(), near) / len(w)
                if share < LCS_SHARE:
                    return
                said = lcs(answer, near) / len(answer) if answer else None
                found = (share, float(cosine), -1.0 if said is None else said, int(start))
                if (said is None or said >= ANSWER_SHARE) and found > best.get((d, item), (-1.0,)):
                    best[d, item] = found

            here = np.zeros((1 << TERM_BITS) + 1, bool)
            ends, kind, number = rare.candidates(offsets, flat)
            for d in range(batch.num_rows):
                words = flat[offsets[d]: offsets[d + 1]]
                if not len(words):
                    continue
                lo, hi = ends[d], ends[d + 1]
                if lo == hi:
                    continue
                terms = _terms(words)
                here[terms] = True
                enough = []
                for k, (_, c) in enumerate(classes):
                    some = number[lo:hi][kind[lo:hi] == k]
                    enough.append(some[here[c.grid[some]].sum(axis=1) >= c.least[some]])
                here[terms] = False
                sums = None
                for (size, c), may in zip(classes, enough, strict=True):
                    if not len(may):
                        continue
                    own, q, grid, has, length, least = c.own, c.q, c.grid, c.has, c.length, c.least
                    if sums is None:
                        sums = _running_sums(vectors, terms)
                    start = np.arange(0, max(1, len(words) - size // 2), size // 2)
                    stop = np.minimum(start + size, len(words))
                    v = sums[-(-stop // UNIT)] - sums[start // UNIT]
                    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                    cos = v @ q[may].T
                    near_rows, near_items = _enough(terms, *np.nonzero(cos >= threshold), start, stop, may, has, length)
                    for i in np.unique(near_rows):
                        # Words of the window's surroundings as a table: bounds the subsequence of every candidate at once.
                        js = near_items[slice(*np.searchsorted(near_rows, (i, i + 1)))]
                        half = grid.shape[1] // 2
                        around = terms[max(0, start[i] - half): stop[i] + half]
                        here[around] = True
                        some = may[js]
                        fit_here = here[grid[some]].sum(axis=1) >= least[some]
                        here[around] = False
                        for j in js[fit_here]:
                            confirm(d, words, start[i], stop[i], *own[may[j]], cos[i, j])
            met = set(best)
            for d, r, begin in _seeded(tables, offsets, flat).tolist():
                item, w, answer = items.value[r]
                if (d, item) in met or (d, item) in best and len(w) < SHORT_ITEM and not answer:
                    continue
                w, words = np.asarray(w, np.int32), flat[offsets[d]: offsets[d + 1]]
                start, stop = max(0, begin), min(begin + len(w), len(words))
                confirm(d, words, start, stop, item, w, answer, s.embed(_terms(words[start:stop])) @ s.embed(_terms(w)))
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[d] for d, _ in best], pa.int64()), pa.array([i for _, i in best], pa.int64()),
                pa.array([f[1] for f in best.values()], pa.float64()), pa.array([f[0] for f in best.values()], pa.float64()),
                pa.array([None if f[2] < 0 else f[2] for f in best.values()], pa.float64()), pa.array([f[3] for f in best.values()], pa.int32())],
                names=["doc_id", "item_id", "cosine", "lcs", "answer", "at"])
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", answer_col: str | None = None,
                  threshold: float = COSINE) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer, at): documents that hold an item or a paraphrase, best stretch each."""
    spark = docs.sparkSession
    ids = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), word_ids(F.col(text_col)).alias("ids")), "op10ids")
    space = spark.sparkContext.broadcast(fit_space(ids))  # size fixed by TERM_BITS and RANK
    words = word_ids(F.col(item_text))
    answer = word_ids(F.col(answer_col)) if answer_col else F.array().cast("array<int>")
    bench = (benchmark.select(F.col(item_col).cast("long").alias("item"), words.alias("w"),
                              *([F.col(answer_col)] if answer_col else []))
             .filter("item is not null and size(w) > 0").select("item", "w", answer.alias("a")))
    # Items are a query set: taken in blocks of bounded size, each against all rows.
    blocks = -(-bench.count() // ITEM_BLOCK)
    out = None
    for b in range(blocks):
        part = bench.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b) if blocks > 1 else bench
        items = spark.sparkContext.broadcast([(r.item, r.w, r.a) for r in part.orderBy("item").collect()])
        found = ids.mapInArrow(tidy(_search(space, items, threshold)), FOUND)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], FOUND)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without the contaminated ones."""
    found = contamination(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(found, id_col, "left_anti")
