"""Document frequency, tf-idf weights, weighted sentence vectors, cosine.

Vectors are ``array<double>``, or binaries of one byte per component. The expressions here are the set-based form of
the per-sentence computation; the flagship retrieval (``scoring.py``) uses the same formulas inside vectorised kernels.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sentsift.operators.prepare import add_row_index
from sentsift.session import ship_package

# Weight sums with a smaller magnitude count as zero (no vector).
ZERO_WEIGHT_EPS = 1e-12


def dot(a, b) -> Column:
    a, b = _c(a), _c(b)
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    a = _c(a)
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a, b) -> Column:
    """Cosine similarity; NULL when either vector is empty or all zero."""
    na, nb = norm(a), norm(b)
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb))


def inverse_doc_frequency(n, df) -> Column:
    """``ln(n / (df + 1))`` with a missing df counted as 0 (may be 0 or negative)."""
    return F.log(_c(n).cast("double") / (F.coalesce(_c(df), F.lit(0)) + 1))


UNIQUE = 200_000  # tokens that a task holds to tell repeats


def batch_tokens(lists: DataFrame) -> DataFrame:
    """``(token)`` of rows of one list column ``tokens``: every token at least once, repeats of a task mostly dropped.

    To be followed by ``distinct``: only what a task has not seen yet becomes a row, not every occurrence.
    """
    def run(batches):
        held: list[pa.Array] = []
        for batch in batches:
            held.append(pc.unique(batch.column(0).flatten()))
            if sum(map(len, held)) > UNIQUE:
                held = [pc.unique(pa.concat_arrays(held))]
                if len(held[0]) > UNIQUE // 2:
                    yield pa.RecordBatch.from_arrays(held, names=["token"])
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pc.unique(pa.concat_arrays(held))], names=["token"])
    ship_package(lists.sparkSession)
    return lists.select("tokens").mapInArrow(run, "token string")


HASHED_DIM = 64


def hashed_vectors(tokens: DataFrame) -> DataFrame:
    """``(token, vec)`` for every distinct token: ``HASHED_DIM`` components from MD5 digests of the token.

    A vector source that needs no file and knows every token. ``vec`` is binary, one byte per component; the component
    is the byte less 127.5 (see ``matrix``).
    """
    return tokens.filter("token is not null").select("token").distinct().select("token", hashed_vector("token").alias("vec"))


def hashed_vector(token) -> Column:
    """The vector of a token as ``hashed_vectors`` has it."""
    return F.concat(*[F.unhex(F.md5(F.concat(_c(token), F.lit(str(k))))) for k in range(HASHED_DIM // 16)])


def vocabulary_ranked_vectors(tokens: DataFrame, table: DataFrame) -> DataFrame:
    """``(token, vec)`` for every token: of the rows of ``table`` (vec_id, vec) the one of the token's rank by frequency.

    Ranks count on from the first row after the last, so that no token is left out; ties in frequency go by token.
    """
    # One key holds count and token, so that the many tokens of one count fall into many ranges.
    key = F.concat(F.lpad((F.lit(10 ** 15) - F.count(F.lit(1))).cast("string"), 16, "0"), F.col("token")).alias("k")
    counts = (tokens.select(F.explode("tokens").alias("token")).filter("token is not null").groupBy("token")
              .agg(key)).persist()
    last = table.agg(F.max("vec_id")).first()[0]
    if last is None:
        return counts.select("token", F.array().cast("array<double>").alias("vec")).limit(0)
    ranked = add_row_index(counts, ["k"]).select("token", (F.col("index") % (last + 1)).alias("vec_id"))
    return ranked.join(table.where("vec is not null"), "vec_id").select("token", "vec")


class HashedVectors:
    """The source of ``hashed_vectors``: vectors of any tokens, worked out where they are needed, with no table to join."""

    KEPT = 200_000
    #: Of the process: a Python worker goes on to the next task with the tokens of the last.
    kept: dict[str, bytes] = {}

    def table(self, tokens: DataFrame) -> DataFrame:
        return hashed_vectors(tokens)

    def rows(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(whether known, vectors of the known ones); every token is known."""
        if len(self.kept) > self.KEPT:
            self.kept.clear()
        for t in tokens:
            if t not in self.kept:
                self.kept[t] = b"".join(hashlib.md5(f"{t}{k}".encode()).digest() for k in range(HASHED_DIM // 16))
        return np.ones(len(tokens), bool), matrix(pa.array([self.kept[t] for t in tokens], pa.binary()))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a vector column: lists of numbers, or binaries of one byte per component (byte less 127.5)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 1))
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1) - 127.5
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def sums_by_row(row: np.ndarray, weight: np.ndarray, vectors: np.ndarray, at: np.ndarray, n: int,
                presorted: bool = True, chunk: int = 200_000) -> np.ndarray:
    """n x dim: sums of ``weight * vectors[at]`` by ``row``, worked off in chunks of entries."""
    if not presorted:
        order = np.argsort(row, kind="stable")
        row, weight, at = row[order], weight[order], at[order]
    out = np.zeros((n, vectors.shape[1]))
    for lo in range(0, len(row), chunk):
        r = row[lo: lo + chunk]
        first = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
        out[r[first]] += np.add.reduceat(weight[lo: lo + chunk, None] * vectors[at[lo: lo + chunk]], first, axis=0)
    return out


def document_frequency(tok: DataFrame, keys: list[str], sent: str = "pos") -> DataFrame:
    """Sentences holding each token, per article: ``(*keys, token, df)``.

    ``tok`` has one row per (article keys, sentence, token) — i.e. distinct.
    """
    return tok.groupBy(*keys, "token").agg(F.count(sent).alias("df"))


def document_frequency_of_rows(tok: DataFrame, keys: list[str], out: str = "df") -> DataFrame:
    """``tok`` with the ``document_frequency`` of its token in ``out``; rows dealt by the article's keys stay where they are."""
    return tok.withColumn(out, F.count(F.lit(1)).over(W.partitionBy(*keys, "token")))


def term_frequency(tok: DataFrame, sent_keys: list[str], cnt: str = "cnt") -> DataFrame:
    """``tf = count / in-vocabulary tokens of the sentence``."""
    w = W.partitionBy(*sent_keys)
    return tok.withColumn("tf", F.col(cnt) / F.sum(cnt).over(w))


def weighted_sentence_vector(weighted: DataFrame, keys: list[str], w: str = "w", vec: str = "vec",
                             combine: bool = True, dealt: bool = False) -> DataFrame:
    """``sum of w x vec / sum of w`` per key: ``(*keys, weight_sum, vec array<double>)``.

    Vectors of any source (``matrix``). With ``combine`` every batch sends one packed partial sum per key; without, the
    rows themselves are dealt by key, which moves less where a key has few rows in a batch and ``vec`` is packed; ``dealt``
    rows of a key are in one partition already. A task holds one batch and one sum, whatever the number of rows of a key. The vector is NULL when the weight sum is zero (the
    reference raises there).
    """
    ship_package(weighted.sparkSession)
    rows = weighted.select(*keys, F.col(w).cast("double").alias("w"), F.col(vec).alias("vec"))
    fields = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]
    if combine:
        rows = rows.mapInArrow(_partial_sums(len(keys)), ", ".join([*fields, "w double", "vec binary"]))
    if not dealt:
        rows = rows.repartition(*keys) if keys else rows.repartition(1)
    rows = rows.sortWithinPartitions(*keys) if keys else rows
    return rows.mapInArrow(_final_sums(len(keys), packed=combine),
                            ", ".join([*fields, "weight_sum double", f"`{vec}` array<double>"]))


def _starts(columns: list[pa.Array], n: int) -> np.ndarray:
    """First row of each run of equal keys."""
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        a, b = c.slice(1), c.slice(0, n - 1)
        other = pc.fill_null(pc.not_equal(a, b), False)
        other = pc.or_(other, pc.xor(pc.is_null(a), pc.is_null(b)))
        new[1:] |= other.to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _sum_runs(batch: pa.RecordBatch, n_keys: int, packed: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first rows, weights, sums) of the runs of equal keys of a batch of (keys, w, vec)."""
    starts = _starts(batch.columns[:n_keys], batch.num_rows)
    w = batch.column(n_keys).to_numpy(zero_copy_only=False)
    if packed:
        vectors = np.frombuffer(b"".join(batch.column(n_keys + 1).to_pylist()), float).reshape(batch.num_rows, -1)
        return starts, np.add.reduceat(w, starts), np.add.reduceat(vectors, starts, axis=0)
    vectors = matrix(batch.column(n_keys + 1))
    run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, batch.num_rows)))
    return starts, np.add.reduceat(w, starts), sums_by_row(run, w, vectors, np.arange(batch.num_rows), len(starts))


def _partial_sums(n_keys: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if n_keys:
                order = [(name, "ascending") for name in batch.schema.names[:n_keys]]
                batch = batch.take(pc.sort_indices(batch, sort_keys=order))
            starts, w, sums = _sum_runs(batch, n_keys, packed=False)
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(starts)) for c in batch.columns[:n_keys]), pa.array(w),
                 pa.array([s.tobytes() for s in sums], pa.binary())], names=batch.schema.names)
    return run


def _final_sums(n_keys: int, packed: bool):
    def out(keys: list[pa.Array], w: np.ndarray, sums: np.ndarray, names: list[str]) -> pa.RecordBatch:
        good = np.abs(w) > ZERO_WEIGHT_EPS
        mean = sums / np.where(good, w, 1.0)[:, None]
        ends = np.arange(len(w) + 1) * sums.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(mean.reshape(-1)), mask=pa.array(~good))
        return pa.RecordBatch.from_arrays([*keys, pa.array(w), lists], names=names)

    def run(batches):
        held = None  # (keys as a batch of one row, weight, sum) of the run that may go on
        for batch in batches:
            if batch.num_rows == 0:
                continue
            names = batch.schema.names
            starts, w, sums = _sum_runs(batch, n_keys, packed)
            keys = [c.take(pa.array(starts)) for c in batch.columns[:n_keys]]
            if held is not None:
                if all(a[0].as_py() == b[0].as_py() for a, b in zip(held[0], keys, strict=True)):
                    w[0] += held[1]
                    sums[0] += held[2]
                else:
                    yield out(held[0], np.array([held[1]]), held[2][None], names)
            if len(w) > 1:
                yield out([k.slice(0, len(w) - 1) for k in keys], w[:-1], sums[:-1], names)
            held = [k.slice(len(w) - 1) for k in keys], w[-1], sums[-1]
        if held is not None:
            yield out(held[0], np.array([held[1]]), held[2][None], names)
    return run


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
