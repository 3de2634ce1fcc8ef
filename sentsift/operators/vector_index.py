"""Nearest vectors by inverted lists over centroids, with exact scores in the lists that are probed.

Centroids are fitted on a bounded sample (``SAMPLE`` vectors, by a hash of the key); every row of the table is indexed.
A query probes the lists of its nearest centroids, as many as the sample needs for ``RECALL`` of its true neighbours.
Rows and queries of a list meet in groups of about ``GROUP`` rows and blocks of ``QUERIES`` queries; each group keeps the
best ``k`` of its rows per query, so a list that holds a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sentsift.operators.vectors import matrix
from sentsift.session import ship_package

SAMPLE, LISTS, ROUNDS = 4096, 64, 12
GROUP, QUERIES = 20_000, 512
RECALL, ASKED = 0.97, 256


@dataclass(frozen=True)
class VectorIndex:
    centroids: np.ndarray  # LISTS x dim unit vectors; bounded by the parameters
    probes: int            # lists to look into per query


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm > 0, norm, 1)


def fit_index(vectors: DataFrame, key: str, vec: str, lists: int = LISTS, sample: int = SAMPLE, k: int = 10,
              recall: float = RECALL) -> VectorIndex:
    """Spherical k-means on at most ``sample`` rows; probes by measured recall of the sample's own nearest rows."""
    rows = (vectors.where(F.col(key).isNotNull() & F.col(vec).isNotNull()).orderBy(F.xxhash64(F.col(key).cast("string")), key)
            .limit(sample).select(F.col(vec).cast("array<double>").alias("v")).toArrow())
    m = _unit(matrix(rows.column("v"))) if rows.num_rows else np.zeros((1, 1))
    centroids = m[: min(lists, len(m))].copy()
    for _ in range(ROUNDS):
        own = (m @ centroids.T).argmax(axis=1)
        for c in range(len(centroids)):
            if (own == c).any():
                centroids[c] = m[own == c].sum(axis=0)
        centroids = _unit(centroids)
    own = (m @ centroids.T).argmax(axis=1)
    asked = m[:ASKED]
    true = np.argsort(-(asked @ m.T), axis=1, kind="stable")[:, :k]
    rank = np.argsort(np.argsort(-(asked @ centroids.T), axis=1, kind="stable"), axis=1)
    needed = np.sort(np.take_along_axis(rank, own[true], axis=1).reshape(-1))  # which probe finds each true neighbour
    return VectorIndex(centroids, int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1)


def _assigned(centroids: np.ndarray, probes: int):
    """(key, list, vec) for the ``probes`` nearest centroids of every vector."""
    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            m = _unit(matrix(batch.column(1)))
            at = np.argsort(-(m @ centroids.T), axis=1, kind="stable")[:, :probes]
            row = np.repeat(np.arange(len(m)), at.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(at.reshape(-1).astype(np.int32)),
                 pa.array([v.tobytes() for v in m[row]], pa.binary())], names=["key", "list", "vec"])
    return run


def _best(k: int):
    """Per group of sorted rows (list, grp, part, kind, key, vec): the k best rows of each query (kind 0)."""
    def top(q_keys, q, keys, scores):
        """Keep the k best of what is held and what came."""
        place = np.lexsort((keys, -scores), axis=-1)[:, :k]
        return np.take_along_axis(keys, place, axis=1), np.take_along_axis(scores, place, axis=1)

    def run(batches):
        key, queries, held = None, [], None

        def flush():
            if held is not None:
                q_keys, _, keys, scores = held
                found = np.isfinite(scores)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q_keys, found.sum(axis=1))), pa.array(keys[found]), pa.array(scores[found])],
                    names=["query", "key", "score"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            cols = [batch.column(c).to_numpy() for c in range(4)]
            new = np.ones(batch.num_rows, bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
            starts = np.flatnonzero(new)
            for a, b in zip(starts, np.append(starts[1:], batch.num_rows), strict=True):
                here = tuple(int(c[a]) for c in cols[:3])
                if here != key:
                    yield from flush()
                    key, queries, held = here, [], None
                keys = batch.column(4).slice(a, b - a).to_numpy()
                m = np.frombuffer(b"".join(batch.column(5).slice(a, b - a).to_pylist()), float).reshape(b - a, -1)
                if cols[3][a] == 0:
                    queries.append((keys, m))
                    continue
                if held is None and queries:
                    q_keys, q = np.concatenate([x for x, _ in queries]), np.concatenate([x for _, x in queries])
                    held = (q_keys, q, np.zeros((len(q), 0), np.int64), np.zeros((len(q), 0)))
                if held is not None:
                    q_keys, q, old, scores = held
                    keys = np.hstack([old, np.broadcast_to(keys, (len(q), len(keys)))])
                    held = (q_keys, q, *top(q_keys, q, keys, np.hstack([scores, q @ m.T])))
        yield from flush()
    return run


def search(index: VectorIndex, vectors: DataFrame, queries: DataFrame, key: str, vec: str, k: int = 10, decimals: int = 6) -> DataFrame:
    """``(query, key, score, rank)``: the ``k`` nearest rows of ``vectors`` in the probed lists, by cosine, for every query.

    Keys are whole numbers. Rows and queries without a vector, or with a zero vector, take part with cosine 0 or not at all
    (null). A query that is a row of the table finds itself first.
    """
    ship_package(vectors.sparkSession)

    def dealt(df: DataFrame, probes: int) -> DataFrame:
        rows = df.where(F.col(key).isNotNull() & F.col(vec).isNotNull()).select(
            F.col(key).cast("long").alias("key"), F.col(vec).cast("array<double>").alias("v"))
        return rows.mapInArrow(_assigned(index.centroids, probes), "key long, list int, vec binary")

    groups = max(1, -(-vectors.count() // GROUP))
    parts = max(1, -(-queries.count() * index.probes // (QUERIES * max(1, len(index.centroids)))))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda n: F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
    asked = dealt(queries, index.probes).select("list", every(groups).alias("grp"), deal(parts).alias("part"), F.lit(0).alias("kind"), "key", "vec")
    held = dealt(vectors, 1).select("list", deal(groups).alias("grp"), every(parts).alias("part"), F.lit(1).alias("kind"), "key", "vec")
    order = ["list", "grp", "part"]
    found = (asked.unionByName(held).repartition(*order).sortWithinPartitions(*order, "kind", "key")
             .mapInArrow(_best(k), "query long, key long, score double").withColumn("score", F.round("score", decimals)))
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "key"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)
