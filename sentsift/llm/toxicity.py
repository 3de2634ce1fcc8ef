"""Toxicity: a convolutional text classifier trained in numpy.

A word (letters only, lower case) has the sum of two hashed embeddings, of the word and of its first ``PREFIX``
letters, so one colliding hash gives half a vector at most and unseen forms of a known stem are recognised. Filters over 1, 2 and 3 neighbouring words, ReLU, maximum over the whole text, one logistic unit. Words
without a significant association to the label (or in fewer than ``MIN_DOCS`` training texts) keep a zero vector, so
unseen words are neutral however long a text is.

Thresholds are calibrated by language: a text's language is guessed from its function words (the ``lang`` column is no
input), the cut of each language is the one of best F1 on the calibration part, shrunk to the common cut where
a language has few rows. The score is the logistic of (logit - cut of the language), so 0.5 is every language's cut.

The fit takes at most ``MAX_POSITIVE`` + ``MAX_NEGATIVE`` labelled rows (a documented bound) to one task; scoring covers every
row and whole texts, in blocks of ``CHUNK`` words.

Edge cases: null and empty texts have no words and score as the bias alone; repeated rows score alike; null labels and
labels of absent documents are not learned; without labels of both kinds every score is 0 ("not toxic"); an
empty table gives an empty result; extra columns are kept by ``score``; a null id is held out like its text "".
"""

from __future__ import annotations

import hashlib
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from sentsift.llm.common import tidy

BITS, DIM, FILTERS, WIDTHS = 17, 16, 16, (1, 2, 3)
MAX_POSITIVE, MAX_NEGATIVE = 2000, 3000
MIN_DOCS, CHANCE, EPOCHS, RATE, DECAY, SEED = 3, 4.0, 5, 0.05, 1e-4, 7
CHUNK = 1 << 14
WORDS = 1 << 17  # scored at a time
PREFIX = 5
SHRINK = 40
#: Function words by language (fixed values).
FUNCTION_WORDS = {
    "en": "the and of to in is that for it with was on be by this from or are an not",
    "es": "el los las del y en que por con para una es al lo como más su se no un",
    "fr": "le les des et du la en une est pour dans qui que pas sur par au avec de un",
    "de": "der die das und den von zu mit ist im nicht ein eine auf für dem des sich in als",
}


def held_out(id_col: Column) -> Column:
    """Rows that no label may be learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def tokens(text: Column) -> Column:
    """For each lower-case letter run of a text: 32 hash bits of its first letters, then 32 of the whole."""
    w = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+")
    return F.transform(F.filter(w, lambda x: x != ""), lambda x: F.shiftleft(
        F.hash(F.left(x, F.lit(PREFIX))).cast("long"), 32).bitwiseOR(F.hash(x).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))


@dataclass
class ToxicityModel:
    tables: np.ndarray   # (2, 2^BITS, DIM)
    filters: np.ndarray  # (DIM, offsets x FILTERS), offsets of all widths side by side
    bias: np.ndarray     # (widths, FILTERS)
    weight: np.ndarray   # (widths x FILTERS)
    intercept: float
    languages: dict      # low hash bits of function words -> language number
    cuts: np.ndarray     # logit cut by language, the last one for none

    def __getstate__(self) -> dict:
        """Most words have no embedding, so a model is sent as the rows that do."""
        used = [np.flatnonzero(t.any(axis=1)) for t in self.tables]
        return {**self.__dict__, "tables": [(u, t[u]) for u, t in zip(used, self.tables, strict=True)]}

    def __setstate__(self, state: dict) -> None:
        tables = np.zeros((2, 1 << BITS, DIM), np.float32)
        for table, (used, rows) in zip(tables, state["tables"], strict=True):
            table[used] = rows
        self.__dict__.update(state, tables=tables)

    def pooled(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Maxima of every filter over each text, in blocks that overlap by the widest filter."""
        n, widest = len(flat), max(WIDTHS)
        docs = len(offsets) - 1
        top = np.zeros((docs, len(WIDTHS) * FILTERS), np.float32)
        owner = np.repeat(np.arange(docs), np.diff(offsets))
        h1, h2 = _buckets(flat)
        for lo in range(0, n, CHUNK):
            hi = min(n, lo + CHUNK + widest - 1)
            x = self.tables[0][h1[lo:hi]] + self.tables[1][h2[lo:hi]]
            y = x @ self.filters
            here = owner[lo:hi]
            at = 0
            for k, w in enumerate(WIDTHS):
                m = min(CHUNK, hi - lo - w + 1)
                if m > 0:
                    z = y[:m, at: at + FILTERS].copy()
                    for j in range(1, w):
                        z += y[j: j + m, at + j * FILTERS: at + (j + 1) * FILTERS]
                    z += self.bias[k]
                    if w > 1:
                        z[here[:m] != here[w - 1: w - 1 + m]] = 0
                    first = np.flatnonzero(np.r_[True, here[1:m] != here[: m - 1]])
                    best = np.maximum.reduceat(z, first, axis=0)
                    cols = slice(k * FILTERS, (k + 1) * FILTERS)
                    top[here[first], cols] = np.maximum(top[here[first], cols], best)
                at += w * FILTERS
        return top

    def logits(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.pooled(flat, offsets) @ self.weight + self.intercept

    def language(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Number of the language with most function words in each text; the number of languages for none."""
        kinds = len(FUNCTION_WORDS)
        table = np.full(1 << BITS, kinds, np.int64)
        for bucket, lang in self.languages.items():
            table[bucket] = lang
        docs = len(offsets) - 1
        owner = np.repeat(np.arange(docs), np.diff(offsets))
        counts = np.bincount(owner * (kinds + 1) + table[_buckets(flat)[0]], minlength=docs * (kinds + 1))
        counts = counts.reshape(docs, kinds + 1)[:, :kinds]
        return np.where(counts.max(axis=1, initial=0) > 0, counts.argmax(axis=1), kinds)

    def scores(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        z = self.logits(flat, offsets) - self.cuts[self.language(flat, offsets)]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -500, 500)))


def _buckets(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u = flat.view(np.uint64)
    mask = np.uint64((1 << BITS) - 1)
    return (u & mask).astype(np.int64), ((u >> np.uint64(32)) & mask).astype(np.int64)


def sample_labels(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
                  positive: int = MAX_POSITIVE, negative: int = MAX_NEGATIVE) -> DataFrame:
    """(label, text) of at most the given numbers of labelled rows that are not held out, chosen by a hash of the id."""
    usable = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
              .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).alias("label")))
    order = F.xxhash64(F.col("__id").cast("string"))
    some = lambda y, n: usable.filter(F.col("label") == y).orderBy(order, "__id").limit(n)
    picked = F.broadcast(some(1, positive).unionByName(some(0, negative)))  # bounded by the two parameters
    base = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    return base.join(picked, "__id").groupBy("__id").agg(F.max("label").alias("label"), F.max("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text") -> ToxicityModel:
    """Trained in one task on the bounded sample; the driver gets the model alone."""
    spark = docs.sparkSession
    names = [(k, w) for k, ws in enumerate(FUNCTION_WORDS.values()) for w in ws.split()]
    hashed = spark.createDataFrame(names, "k int, w string").select("k", tokens(F.col("w"))[0].alias("h")).collect()
    shared: dict[int, set[int]] = {}
    for r in hashed:
        shared.setdefault(int(_buckets(np.array([r.h]))[0][0]), set()).add(r.k)
    languages = {b: next(iter(ks)) for b, ks in shared.items() if len(ks) == 1}  # words of one language only

    def run(batches):
        one: dict[tuple, tuple] = {}  # copies teach once
        for batch in batches:
            at, flat = _lists(batch.column(1))
            for k, lo, hi in zip(batch.column(0).to_pylist(), at[:-1], at[1:], strict=True):
                one[k, hashlib.sha256(flat[lo:hi]).digest()] = (flat[lo:hi], k)
        model = train([t for t, _ in one.values()], np.array([k for _, k in one.values()], np.int64), languages)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    rows = sample_labels(docs, labels, label_col, id_col, text_col)
    made = (rows.repartition(1).sortWithinPartitions("__id").select(F.col("label").cast("int"), tokens(F.col("text")).alias("t"))
            .mapInArrow(tidy(run), "model binary").first())
    return pickle.loads(made.model) if made is not None else _empty(languages)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, values) of a list column."""
    at = column.offsets.to_numpy().astype(np.int64)
    return at - at[0] if len(at) else at, column.flatten().to_numpy(zero_copy_only=False)


def _empty(languages: dict) -> ToxicityModel:
    k = len(WIDTHS) * FILTERS
    return ToxicityModel(np.zeros((2, 1 << BITS, DIM), np.float32), np.zeros((DIM, sum(WIDTHS) * FILTERS), np.float32),
                         np.zeros((len(WIDTHS), FILTERS), np.float32), np.zeros(k, np.float32), -500.0, languages,
                         np.zeros(len(FUNCTION_WORDS) + 1))


def association(once: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words whose presence goes with the label, and the signed root of their log-likelihood ratio beyond chance.

    ``once`` holds the distinct words of each text. The root is about standard normal for an unrelated word, so ``CHANCE`` is
    taken off; words within it are left out.
    """
    ones, zeros = int(y.sum()), int((1 - y).sum())
    values, n = np.unique(np.concatenate(once), return_counts=True)
    values, n = values[n >= MIN_DOCS], n[n >= MIN_DOCS].astype(float)  # most words are rare
    seen_in, times = np.unique(np.concatenate([o for o, k in zip(once, y, strict=True) if k]), return_counts=True)
    p = np.zeros(len(values))
    _, at, found = np.intersect1d(values, seen_in, assume_unique=True, return_indices=True)
    p[at] = times[found]
    n -= p
    rate = (p + n) / (ones + zeros)

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)

    ratio = 2 * (part(p, ones * rate) + part(n, zeros * rate) + part(ones - p, ones * (1 - rate))
                 + part(zeros - n, zeros * (1 - rate)))
    root = np.sqrt(np.maximum(ratio, 0)) * np.sign(p / ones - n / zeros)
    keep = np.abs(root) > CHANCE
    return values[keep], (np.abs(root[keep]) - CHANCE) * np.sign(root[keep])


def train(sets: list[np.ndarray], y: np.ndarray, languages: dict) -> ToxicityModel:
    """Embeddings start from label association, then all weights are learned together by Adagrad on batches of texts.

    Words without an association have a zero vector and stay so; runs of them are shortened to one filter width, which
    changes no maximum.
    """
    m = _empty(languages)
    if len(y) == 0 or y.min() == y.max():
        return m
    rng = np.random.default_rng(SEED)
    calibrate = rng.random(len(y)) < 0.25
    learn = np.flatnonzero(~calibrate)
    if len(set(y[learn])) < 2 or len(set(y[calibrate])) < 2:
        learn, calibrate = np.arange(len(y)), np.ones(len(y), bool)
    halves = [lambda s: s.astype(np.uint32), lambda s: (s >> 32).astype(np.uint32)]  # made text by text
    found = [association([np.unique(half(sets[i])) for i in learn], y[learn]) for half in halves]
    known = [k for k, _ in found]
    if not any(map(len, known)):
        return m
    # Row 0 is the zero vector; then words, then stems. The first component starts as the association.
    signal = np.concatenate([g for _, g in found])
    vectors = np.vstack([np.zeros((1, DIM)), rng.normal(0, 0.02, (len(signal), DIM))]).astype(np.float32)
    vectors[1:, 0] += signal / np.abs(signal).max()
    filters = rng.normal(0, 0.2, (DIM, sum(WIDTHS) * FILTERS)).astype(np.float32)
    bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
    weight = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
    first, learned = [1, 1 + len(known[0])], set(learn.tolist())
    short = [_shorten(np.stack([_places(half(s), k, f) for half, k, f in zip(halves, known, first, strict=True)]))
             if i in learned else None for i, s in enumerate(sets)]
    params = {"vectors": vectors, "filters": filters, "bias": bias, "weight": weight}
    state = {k: np.full_like(v, 1e-2) for k, v in params.items()}
    intercept, spots = 0.0, np.cumsum([0, *WIDTHS])
    balance = np.where(y == 1, 0.5 / max(1, (y[learn] == 1).sum()), 0.5 / max(1, (y[learn] == 0).sum())) * len(learn)
    for _ in range(EPOCHS):
        order = rng.permutation(learn)
        batches = [order[i: i + 64] for i in range(0, len(order), 64)]
        for batch in batches:
            words = np.zeros((2, len(batch), max(short[d].shape[1] for d in batch)), np.int32)
            for r, d in enumerate(batch):
                words[:, r, : short[d].shape[1]] = short[d]
            top, places = np.zeros((len(batch), len(weight)), np.float32), np.zeros((len(WIDTHS), len(batch), FILTERS), np.int64)
            for r, d in enumerate(batch):  # by themselves: together all texts would be as long as the longest
                x = vectors[short[d][0]] + vectors[short[d][1]]
                for k, w in enumerate(WIDTHS):
                    n = len(x) - w + 1
                    z = sum(x[j: j + n] @ filters[:, (spots[k] + j) * FILTERS:(spots[k] + j + 1) * FILTERS]
                            for j in range(w)) + bias[k]
                    places[k, r] = z.argmax(axis=0)
                    top[r, k * FILTERS:(k + 1) * FILTERS] = np.maximum(z.max(axis=0), 0)
            logit = top @ weight + intercept
            g = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - y[batch]) * balance[batch] / len(batch)
            dz = g[:, None] * weight * (top > 0)
            grads = {"weight": top.T @ g, "bias": dz.sum(axis=0).reshape(bias.shape),
                     "filters": np.zeros_like(filters), "vectors": np.zeros_like(vectors)}
            rows = np.arange(len(batch))[:, None]
            for k, w in enumerate(WIDTHS):
                part = dz[:, k * FILTERS:(k + 1) * FILTERS]
                for j in range(w):
                    cols = slice((spots[k] + j) * FILTERS, (spots[k] + j + 1) * FILTERS)
                    at = places[k] + j
                    here = vectors[words[0][rows, at]] + vectors[words[1][rows, at]]
                    grads["filters"][:, cols] += np.einsum("bfd,bf->df", here, part)
                    slope = (part[:, :, None] * filters[:, cols].T[None]).reshape(-1, DIM)
                    for half in words:
                        np.add.at(grads["vectors"], half[rows, at].ravel(), slope)
            grads["vectors"][0] = 0
            intercept -= RATE * float(g.sum())
            for k, v in params.items():
                step = grads[k] + DECAY * v
                state[k] += step * step
                v -= (RATE * step / np.sqrt(state[k])).astype(np.float32)
    for t, (k, f) in enumerate(zip(known, first, strict=True)):
        np.add.at(m.tables[t], k & ((1 << BITS) - 1), vectors[f: f + len(k)])
    m.filters, m.bias, m.weight, m.intercept = filters, bias, weight, intercept
    _calibrate(m, sets, y, calibrate)
    return m


def _places(half: np.ndarray, known: np.ndarray, first: int) -> np.ndarray:
    """Row of every word among the sorted ``known`` ones, counted on from ``first``; 0 for others."""
    at = np.minimum(np.searchsorted(known, half), max(len(known) - 1, 0)).astype(np.int32)
    return np.where(known[at] == half, at + np.int32(first), 0) if len(known) else np.zeros(len(half), np.int32)


def _shorten(words: np.ndarray) -> np.ndarray:
    """Zero words further than one filter width from any other are dropped, but for one such window at the end."""
    near = words.any(axis=0)
    for _ in range(max(WIDTHS) - 1):
        wide = near.copy()
        wide[1:] |= near[:-1]
        wide[:-1] |= near[1:]
        near = wide
    return np.hstack([words[:, near], np.zeros((2, max(WIDTHS)), words.dtype)])


def _best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """Middle of the widest gap between logits among the cuts of best F1."""
    order = np.argsort(-z)
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    nxt = np.append(z[order][1:], z[order][-1] - 2)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    i = best[np.argmax(z[order][best] - nxt[best])]
    return float((z[order][i] + nxt[i]) / 2)


def _calibrate(m: ToxicityModel, sets: list[np.ndarray], y: np.ndarray, rows: np.ndarray) -> None:
    at = np.flatnonzero(rows)
    flat = np.concatenate([sets[i] for i in at])
    offsets = np.r_[0, np.cumsum([len(sets[i]) for i in at])]
    z, lang, t = m.logits(flat, offsets), m.language(flat, offsets), y[at]
    common = _best_cut(z, t)
    for k in range(len(m.cuts)):
        own = lang == k
        n = int(min(t[own].sum(), (1 - t[own]).sum()))
        m.cuts[k] = (n * _best_cut(z[own], t[own]) + SHRINK * common) / (n + SHRINK) if n else common


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with ``out_col``: toxicity from 0 to 1 of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # size fixed by BITS and DIM
    columns = [c for c in docs.columns if c != out_col]
    held = "__tokens"
    while held in columns:
        held += "_"
    source = docs.select(*(F.col(f"`{c}`") for c in columns), tokens(F.col(f"`{text_col}`")).alias(held))

    def run(batches):
        m = shared.value
        for batch in batches:
            offsets, flat = _lists(batch.column(batch.num_columns - 1))
            out, lo = [], 0
            while lo < batch.num_rows:  # some texts of about WORDS words, or one longer text
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + WORDS, side="right")) - 1)
                out.append(m.scores(flat[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]))
                lo = hi
            scores = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*columns, out_col])

    return source.mapInArrow(tidy(run), StructType(source.schema.fields[:-1]).add(out_col, DoubleType()))
