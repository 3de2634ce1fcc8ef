"""Index search against exact search."""

import numpy as np
import pytest

from sentsift.operators import vector_index
from sentsift.plans import registry
from library_data import SF_SMALL


def exact(rows, asked, k):
    m = np.array([v for _, v in rows])
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    ids = np.array([i for i, _ in rows])
    out = {}
    for i, v in asked:
        s = m @ (np.array(v) / np.linalg.norm(v))
        out[i] = set(ids[np.lexsort((ids, -s.round(6)))[:k]].tolist())
    return out


@pytest.fixture(scope="module")
def rows():
    """Clusters of very different sizes, one with a third of all rows."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16))
    sizes = [700] + [45] * 29
    return [(n, (centres[c] + 0.4 * rng.normal(size=16)).tolist())
            for n, c in enumerate(c for c, size in enumerate(sizes) for _ in range(size))]


def test_recall_and_scores(spark, rows, monkeypatch):
    monkeypatch.setattr(vector_index, "GROUP", 300)
    monkeypatch.setattr(vector_index, "QUERIES", 4)
    df = spark.createDataFrame(rows + [(None, [1.0] * 16), (9999, None)], "id long, v array<double>")
    asked = df.where("id % 20 = 0")
    index = vector_index.fit_index(df, "id", "v", lists=24)
    got = {}
    for r in vector_index.search(index, df, asked, "id", "v", k=5).collect():
        got.setdefault(r.query, {})[r.key] = (r.rank, r.score)
    want = exact(rows, [r for r in rows if r[0] % 20 == 0], 5)
    assert set(got) == set(want)
    assert np.mean([len(want[q] & set(got[q])) / 5 for q in want]) >= 0.9
    assert all(got[q][q] == (1, 1.0) and sorted(r for r, _ in got[q].values()) == [1, 2, 3, 4, 5] for q in got)


def test_all_lists_are_exact(spark, rows):
    df = spark.createDataFrame(rows, "id long, v array<double>")
    index = vector_index.fit_index(df, "id", "v", lists=8, sample=200)
    every = vector_index.VectorIndex(index.centroids, len(index.centroids))
    want = exact(rows, [r for r in rows if r[0] % 100 == 0], 3)
    got = {}
    for r in vector_index.search(every, df, df.where("id % 100 = 0"), "id", "v", k=3).collect():
        got.setdefault(r.query, set()).add(r.key)
    assert got == want


def test_empty_tables(spark, rows):
    df = spark.createDataFrame(rows[:50], "id long, v array<double>")
    index = vector_index.fit_index(df, "id", "v", lists=4)
    assert vector_index.search(index, df.limit(0), df, "id", "v").count() == 0
    assert vector_index.search(index, df, df.limit(0), "id", "v").count() == 0
    vector_index.fit_index(df.limit(0), "id", "v")


def test_query_reaches_its_recall(spark):
    got = {}
    for r in registry.queries()["nearest_vectors_index"](spark, SF_SMALL).collect():
        got.setdefault(r["query"], set()).add(r["key"])
    table = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    want = exact(table, [r for r in table if r[0] % 20 == 0], 10)
    assert set(got) == set(want) and np.mean([len(want[q] & got[q]) / 10 for q in want]) >= 0.9
