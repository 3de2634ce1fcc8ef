"""Exact substring dedup by super-k-mers.

A window is ``k`` consecutive words. Consecutive windows whose smallest ``m``-word hash (minimiser) is the same
form a super-k-mer and travel as one packed string to the bucket of that minimiser; equal windows have equal
minimisers and so meet. In its bucket the windows of all packed strings are sorted by their words and counted.

A minimiser that stands at one place only cannot hold a repeated window, so only (hash, position) rows are counted first and
only super-k-mers of repeated minimisers are packed. A minimiser with many super-k-mers (a passage that a third of
all documents hold) is salted: every salt counts its own windows, then sends each distinct window once to a second
count by the window's words.

Edge cases: null text has no words; texts under ``k`` words keep everything; a window that repeats inside one
document counts; repeated rows are copies of each other (all their windows go); rows are told apart by id and text, so
null or repeated ids are safe; a packed string holds at most ``MAX_RUN`` windows, longer runs are split, none is
dropped; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentsift.llm.common import cut, release, word_hashes, words
from sentsift.llm.ngram_join import _flat, _mix

WINDOW = 35
GRAM = 4
MAX_RUN = 256
BUCKET_ROWS = 512


def _runs(k: int, m: int):
    span = k - m + 1

    def run(batches):
        for batch in batches:
            offsets, flat = _flat(batch.column(1))
            n = len(flat)
            if n < k:
                continue
            grams = _mix(flat + np.uint64(1))
            for j in range(1, m):
                grams = _mix(grams[: n - j] + flat[j:])
            low, pos, width = grams, np.arange(len(grams), dtype=np.int32), 1
            while width < span:  # leftmost minimum over 2, 4, 8 ... grams, then over the span
                step = min(width, span - width)
                right = low[step:] < low[: len(low) - step]
                low = np.where(right, low[step:], low[: len(low) - step])
                pos = np.where(right, pos[step:], pos[: len(pos) - step])
                width += step
            counts = np.maximum(np.diff(offsets) - k + 1, 0)
            total = int(counts.sum())
            if not total:
                continue
            doc = np.repeat(np.arange(len(counts)), counts)
            at = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
            place = offsets[:-1][doc] + at
            value, pos = low[place], pos[place]
            new = np.ones(total, bool)
            new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
            start = np.flatnonzero(new)
            age = np.arange(total) - np.repeat(start, np.diff(np.append(start, total)))
            start = np.flatnonzero(age % MAX_RUN == 0)
            length = np.diff(np.append(start, total))
            # A run whose minimiser stands at several places may repeat a window by itself.
            places = 1 + (pos[start] != pos[start + length - 1]).astype(np.int32)
            ids = batch.column(0).take(pa.array(doc[start]))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(value[start].view(np.int64)), pa.array(at[start].astype(np.int32)),
                 pa.array(length.astype(np.int32)), pa.array(places)], names=["rid", "h", "at", "len", "places"])
    return run


def _ranges(flags: list[bool], at: int, k: int):
    """Word ranges [from, to) covered by the flagged windows of a run that starts at ``at``."""
    out = []
    for i, hit in enumerate(flags):
        if hit:
            if out and at + i <= out[-1][1]:
                out[-1][1] = at + i + k
            else:
                out.append([at + i, at + i + k])
    return out


def _bucket(rows: list[tuple], k: int, salted: bool):
    """Ranges of repeated windows in one bucket; of a salted one also its distinct windows with their count."""
    windows, owner = [], []
    for r, (_, at, packed) in enumerate(rows):
        ends = [-1, *(i for i, c in enumerate(packed) if c == " "), len(packed)]
        for i in range(len(ends) - k):
            windows.append(packed[ends[i] + 1: ends[i + k]])
            owner.append((r, i))
    flags = [{} for _ in rows]
    distinct = []
    order = sorted(range(len(windows)), key=windows.__getitem__)
    a = 0
    while a < len(order):
        b = a + 1
        while b < len(order) and windows[order[b]] == windows[order[a]]:
            b += 1
        for j in order[a:b] if b - a > 1 else ():
            flags[owner[j][0]][owner[j][1]] = True
        if salted:
            r, i = owner[order[a]]
            distinct.append((rows[r][0], rows[r][1] + i, rows[r][1] + i + k, windows[order[a]], b - a))
        a = b
    found = []
    for (rid, at, _), f in zip(rows, flags, strict=True):
        if f:
            found += [(rid, x, y, None, 0) for x, y in _ranges([i in f for i in range(max(f) + 1)], at, k)]
    return found + distinct


def _count(k: int):
    """Streams a partition sorted by (h, salt); holds one bucket at a time."""
    names = ["rid", "lo", "hi", "window", "times"]

    def run(frames):
        key, rows, salted, out = None, [], False, []
        for f in frames:
            for h, salt, many, rid, at, packed in zip(f["h"], f["salt"], f["many"], f["rid"], f["at"], f["packed"],
                                                      strict=True):
                if (h, salt) != key:
                    if rows:
                        out += _bucket(rows, k, salted)
                    key, rows, salted = (h, salt), [], many
                rows.append((rid, at, packed))
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
        if rows:
            out += _bucket(rows, k, salted)
        if out:
            yield pd.DataFrame(out, columns=names)
    return run


def _gaps(frames):
    """Kept stretches (from, length) between merged ranges; the last one runs to the end."""
    for f in frames:
        gaps = []
        for spans in f["spans"]:
            end, out = 0, []
            for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
                if lo > end:
                    out.append({"lo": end, "len": lo - end})
                end = max(end, hi)
            out.append({"lo": end, "len": 2**31 - 1 - end})
            gaps.append(out)
        yield pd.DataFrame({"rid": f["rid"], "gaps": gaps})


def repeated_ranges(docs: DataFrame, k: int = WINDOW, m: int = GRAM) -> DataFrame:
    """(rid, lo, hi): word ranges of ``docs`` (rid, text) covered by windows that also start elsewhere."""
    spark = docs.sparkSession
    runs = docs.select("rid", word_hashes(F.col("text")).alias("wh")).mapInArrow(
        _runs(k, m), "rid long, h long, at int, len int, places int")
    runs = cut(runs, "op3runs")
    often = runs.groupBy("h").agg(F.sum("places").alias("c")).filter("c > 1")
    salts = F.ceil(F.col("c") / BUCKET_ROWS).cast("int")
    hits = (runs.join(often, "h")
            .select("rid", "h", "at", "len", F.when(salts > 1, F.pmod(F.xxhash64("rid", "at"), salts)).cast("int").alias("salt"))
            .groupBy("rid").agg(F.collect_list(F.struct("h", "salt", "at", "len")).alias("hits")))
    packed = (docs.join(hits, "rid").select("rid", words(F.col("text")).alias("w"), "hits")
              .select("rid", "w", F.explode("hits").alias("x"))
              .select("rid", F.col("x.h").alias("h"), F.coalesce("x.salt", F.lit(0)).alias("salt"),
                      F.col("x.salt").isNotNull().alias("many"), F.col("x.at").alias("at"),
                      F.array_join(F.slice("w", F.col("x.at") + 1, F.col("x.len") + (k - 1)), " ").alias("packed")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = cut(packed.repartition(parts, "h", "salt").sortWithinPartitions("h", "salt")
                  .mapInPandas(_count(k), "rid long, lo int, hi int, window string, times long"), "op3count")
    release(spark)
    cross = counted.filter("window is not null")
    twice = cross.groupBy("window").agg(F.count("*").alias("salts")).filter("salts > 1")
    late = cross.filter("times = 1").join(twice.select("window"), "window").select("rid", "lo", "hi")
    return counted.filter("window is null").select("rid", "lo", "hi").unionByName(late)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WINDOW,
                    m: int = GRAM) -> DataFrame:
    """One row per input row: (doc_id, n_words, n_removed, kept_text)."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn(
        "rid", F.xxhash64("doc_id", "text"))
    spans = (repeated_ranges(base.select("rid", "text"), k, m).groupBy("rid")
             .agg(F.collect_set(F.struct("lo", "hi")).alias("spans")))
    gaps = cut(spans.mapInPandas(_gaps, "rid long, gaps array<struct<lo:int,len:int>>"), "op3gaps")
    release(spark)
    kept = F.when(F.col("gaps").isNull(), F.col("w")).otherwise(
        F.flatten(F.transform("gaps", lambda g: F.slice(F.col("w"), g["lo"] + 1, g["len"]))))
    return (base.join(gaps, "rid", "left").select("doc_id", words(F.col("text")).alias("w"), "gaps")
            .select("doc_id", F.size("w").cast("long").alias("n_words"), F.size("w").alias("all"), kept.alias("kept"))
            .select("doc_id", "n_words", (F.col("all") - F.size("kept")).cast("long").alias("n_removed"),
                    F.array_join("kept", " ").alias("kept_text")))
