"""Spelling variant grouping: words one insertion, deletion or replacement apart, found by a variable-length gram index.

1. Dictionary: grams of ``QMIN`` to ``QMAX - 1`` characters that more than one word in ``RARE`` holds, at most
   ``DICTIONARY`` of them. All others are pruned: they are selective enough as they are.
2. Decomposition: the gram at a place of a word starts with ``QMIN`` characters and grows while it is in the
   dictionary, up to ``QMAX``; an end mark closes the word. It depends on its own characters only.
3. Affected grams: an edit at a place affects the grams that hold the place. With at most ``QMAX`` affected ones, a word
   of n characters keeps at least ``n - QMAX`` of its n grams in every near word (``affected`` counts them per word
   and place). Those left of the place keep their distance from the start, those right of it from the end.
4. List merging: two near words meet in the lists of all grams that their edit leaves. These lists are merged at once:
   for each place where a word can be edited, one key stands for all the unaffected grams, where they are, and the number
   of characters in between. A word enters the merged list of every different key, once for edits that take or change a
   character and once for edits that add one. Keys are 64-bit hashes; equal hashes cost a comparison only.
5. Pairs of a merged list are verified by their exact edit distance, in the JVM.

A word enters as many lists as it has characters and a few more, so the index is linear in the words, and a merged
list holds words that agree but for the few characters around one place. Joins are on (key); Spark splits hot keys.

Edge cases: null and empty words have no neighbours and are left out; rows that repeat a word add up their counts; ties go to
the smallest word by code point; extra columns are not read; an empty table gives an empty result; words of any length are
indexed in linear space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentsift.llm.common import cut, drop_cut

QMIN, QMAX = 2, 5
RARE = 16
DICTIONARY = 4096
RATIO = 10
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _characters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(places, code points + 1): the words one after another, an end mark 0 behind each."""
    flat = np.frombuffer("".join(w + "\0" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size)
    flat[ends - 1] = 0
    return np.append(0, ends), flat


def _gram(flat: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` characters from each place on (the last places: of those in the array)."""
    h = np.full(len(flat), size, np.uint64)
    padded = np.append(flat, np.zeros(size, np.uint64))
    for k in range(size):
        h = _mix(h + padded[k: k + len(flat)] * _BASE)
    return h


def _room(offsets: np.ndarray) -> np.ndarray:
    """Characters left in the word at each place, its end mark included."""
    return np.repeat(offsets[1:], np.diff(offsets)) - np.arange(offsets[-1])


def _count_grams(batches):
    for batch in batches:
        words = batch.column(0).to_pylist()
        offsets, flat = _characters(words)
        owner, room = np.repeat(np.arange(len(words)), np.diff(offsets)), _room(offsets)
        found, times = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for size in range(QMIN, QMAX):
            fits = room >= size
            held = np.unique(np.stack([_gram(flat, size)[fits], owner[fits].astype(np.uint64)]), axis=1)  # once per word
            g, n = np.unique(held[0], return_counts=True)
            found.append(g)
            times.append(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(times))],
                                         names=["gram", "n"])


def gram_dictionary(words: DataFrame) -> np.ndarray:
    """Sorted hashes of the grams that more than one word in ``RARE`` holds; at most ``DICTIONARY``."""
    total = words.count()
    rows = (words.select("word").mapInArrow(_count_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
            .filter(F.col("n") * RARE > total).orderBy(F.desc("n"), "gram").limit(DICTIONARY).select("gram").collect())
    return np.sort(np.array([r.gram for r in rows], np.int64).view(np.uint64))


def gram_ends(offsets: np.ndarray, flat: np.ndarray, dictionary: np.ndarray) -> np.ndarray:
    """End of the gram that starts at each place; 0 where the word is over before ``QMIN`` characters."""
    room = _room(offsets)
    size = np.full(len(flat), QMIN)
    growing = np.ones(len(flat), bool)
    for k in range(QMIN, QMAX):
        growing &= (room > k) & np.isin(_gram(flat, k), dictionary)
        size += growing
    return np.where(room >= QMIN, np.arange(len(flat)) + size, 0)


def affected(word: str, dictionary: np.ndarray) -> list[int]:
    """For each character of a word, the number of its grams that a change of the character affects."""
    ends = gram_ends(*_characters([word]), dictionary)
    return [int(sum(i <= p < e for i, e in enumerate(ends))) for p in range(len(word))]


def _keys(dictionary: np.ndarray):
    def run(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            offsets, flat = _characters(words)
            start = np.repeat(offsets[:-1], np.diff(offsets))
            place = np.arange(len(flat))
            local = place - start
            n = np.repeat(np.diff(offsets) - 1, np.diff(offsets))
            powers = np.full(int(n.max(initial=0)) + 2, _BASE)
            powers[0] = 1
            powers = np.multiply.accumulate(powers)
            # total[x]: hash of the word's characters before x; the last one of a word has all of them.
            whole = np.append(np.uint64(0), np.cumsum(flat * powers[local], dtype=np.uint64))
            total = whole[:-1] - whole[start]
            last = whole[start + n] - whole[start]
            ends = gram_ends(offsets, flat, dictionary)
            ending = np.zeros(len(flat) + 1, np.int64)
            ending[ends[ends > 0]] = ends[ends > 0]
            left = np.maximum(np.maximum.accumulate(ending[:-1]), start)  # end of the grams left of each place
            out = []
            for gone in (1, 0):  # a character is taken or changed; a character is added
                at = place[local < n] if gone else place
                right = at + gone
                right = np.where(local[at] + gone <= n[at] + 1 - QMIN, right, start[at] + n[at])  # first gram right of it
                lo = left[at]
                between = right - lo - gone
                rest = last[at] - (whole[right] - whole[start[at]])
                key = total[lo] + (rest * _BACK if gone else rest)
                spot = np.where(between > 0, (lo - start[at] + 1) * 64 + between, 0).astype(np.uint64)
                key = _mix(key + _mix(spot * _BASE + (n[at] - gone).astype(np.uint64)))
                owner = np.searchsorted(offsets, at, side="right") - 1
                pair = np.unique(np.stack([owner.astype(np.uint64), key]), axis=1)
                out.append((pair[0].astype(np.int64), pair[1], np.full(pair.shape[1], not gone)))
            owner = np.concatenate([o for o, _, _ in out])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([k for _, k, _ in out]).view(np.int64)), batch.column(0).take(pa.array(owner)),
                 batch.column(1).take(pa.array(owner)), pa.array(np.concatenate([a for _, _, a in out]))],
                names=["key", "word", "n", "adds"])
    return run


def merged_lists(words: DataFrame) -> DataFrame:
    """(key, word, n, adds): the merged lists of ``words`` (word, n), a table in the shared folder."""
    keys = _keys(gram_dictionary(words))
    return cut(words.select("word", "n").mapInArrow(keys, "key long, word string, n long, adds boolean"), "op12lists")


def near_words(lists: DataFrame) -> DataFrame:
    """(word, other, other_n): each pair of words one edit apart, in both directions, once; from ``merged_lists``."""
    # A word that loses a character meets the one that gains it; two that change one meet as losers.
    a = lists.filter("not adds").select("key", F.col("word").alias("a"), F.col("n").alias("na"))
    b = lists.select("key", F.col("word").alias("b"), F.col("n").alias("nb"), "adds")
    pairs = a.join(b, "key").filter("(adds or a < b) and levenshtein(a, b, 1) = 1")
    return (pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("other_n")))).alias("e"))
        .select("e.*").distinct())


def spelling_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the distinct words of ``words`` (word, n).

    ``form``: the near word of largest n (ties: the smallest), if that is ``ratio`` times the word's n or more.
    ``root``: the last word of the chain of forms, the word itself if it has none. Counts grow ``ratio``-fold along a
    chain, so it has at most log(largest n) links; they are followed by doubling.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words = cut(words.filter("word <> '' and n is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "op12words")
    lists = merged_lists(words)
    best = near_words(lists).groupBy("word").agg(F.count("*").alias("n_near"),
                                                 F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("top"))
    known = (words.join(best, "word", "left")
             .withColumn("has", F.coalesce(-F.col("top.m") >= ratio * F.col("n"), F.lit(False)))
             .select("word", F.when(F.col("has"), F.col("top.other")).alias("form"), "n",
                     F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                     F.when(F.col("has"), -F.col("top.m")).alias("form_n")))
    known = cut(known, "op12forms")
    drop_cut(lists)
    chain = known.filter("form is not null").select("word", F.col("form").alias("root"))
    most = words.agg(F.max("n")).first()[0] or 1
    drop_cut(words)
    links, span = 1, 1
    while ratio ** links <= most:
        links += 1
    while span < links:
        step = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        chain = cut(chain.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "op12chain")
        span *= 2
    return (known.join(chain, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def vocabulary(runs: DataFrame, least: int = 2, shortest: int = 7) -> DataFrame:
    """(word, n): words of at least ``shortest`` characters that occur ``least`` times or more in ``runs`` (word)."""
    return (runs.filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= least))


def letter_runs(text: Column, shortest: int) -> Column:
    """Maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of at least ``shortest`` characters."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{shortest},}}"), F.lit(0))
