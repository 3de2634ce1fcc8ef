"""Registered queries against their DuckDB SQL; the vector SQL on vectors with links."""

import duckdb
import numpy as np
import pytest

from sentsift.llm import embedding_dedup, registry

SF = "/root/testdata/sf0.001"
NAMES = sorted(registry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    cur = con.execute(registry.oracle_sql()[name])
    assert sorted(d[0] for d in cur.description) == columns
    at = [[d[0] for d in cur.description].index(c) for c in columns]
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(
        repr(tuple(r[i] for i in at)) for r in cur.fetchall())


def test_vector_sql_on_planted_links(spark):
    """Chains, copies and clearly separate vectors: no pair near the threshold, so the search has to find all."""
    rng = np.random.default_rng(9)
    rows = []
    for g in range(40):
        base = rng.normal(size=24)
        for k in range(int(rng.integers(1, 5))):
            rows.append((len(rows), (base + 0.08 * k * rng.normal(size=24)).tolist()))
    rows += [(1000, rows[3][1]), (1001, [0.0] * 24), (1002, None), (1003, [1e-200] * 24), (1004, [2e-200] * 24)]
    c = duckdb.connect()
    c.execute("create table embeddings (vec_id bigint, embedding double[])")
    c.executemany("insert into embeddings values (?, ?)", rows)
    want = set(c.execute(registry.OP4_SQL).fetchall())
    out = embedding_dedup.near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in out.collect()}
    assert sum(r[1] > 0 for r in want) > 50
    assert sum(r in got for r in want) >= 0.97 * len(want)
