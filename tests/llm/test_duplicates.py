"""N-gram join, substring dedup and embedding dedup against brute force."""

import collections
import re

import numpy as np

from sentsift.llm import embedding_dedup, ngram_join, substring_dedup
from sentsift.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def expected_join(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    comp = groups(sets, links)
    return {i: (len(s), comp[i]) for i, s in sets.items()}


def test_ngram_join(docs, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(docs).collect()}
    assert got == expected_join(rows)


def test_ngram_join_of_lists_that_need_many_pivots(spark):
    """Texts that share most shingles in many different ways; some only link through others."""
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for j in rng.integers(0, 60, rng.integers(0, 5)):
            w[j] = f"v{rng.integers(0, 6)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(f"u{j}" for j in range(i % 4, 9 + i % 5))) for i in range(25)]
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected_join(rows)


def test_link_counts(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "PAIR_BLOCK", 3)
    words = [f"w{k}" for k in range(60)]
    near = [(950000 + k, " ".join(words[:40 + k % 9])) for k in range(18)]
    every = rows + near
    sets = {}
    for i, t in every:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    links = collections.Counter(a for a in sets for b in sets if a != b and sets[a] and sets[b]
                                and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    got = {r.doc_id: (r.n_shingles, r.n_links) for r in ngram_join.link_counts(more).collect()}
    assert got == {i: (len(s), links[i]) for i, s in sets.items()}


def test_keep_one_and_null_ids(spark):
    d = spark.createDataFrame([(1, "a b c d e f"), (2, "A B c d e f"), (None, "a b c d e f"), (3, "z")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in ngram_join.keep_one(d).collect()) == ["1", "3", "None"]


def test_keep_one_of_repeated_rows(spark):
    """Equal rows leave one; one id with two texts keeps both; other columns and copies by other ids as before."""
    rows = [(1, "a b c d e f", 1), (1, "a b c d e f", 2), (2, "a b c d e f", 3), (2, "a b c d e f", 3), (5, "x y", 4), (5, "z w", 5),
            (5, "z w", 6), (None, "q", 7), (None, "q", 7), (6, None, 8), (6, None, 9)]
    out = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string, n long")).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in out) == [(0, "q"), (0, "q"), (1, "a b c d e f"), (5, "x y"), (5, "z w"), (6, "")]


def test_light_sets_and_their_boundary(spark):
    """Small sets that share two frequent shingles: some sizes are light, all links are found."""
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"w{j}" for j in range(i % 3, 9 + i % 4))) for i in range(60)]
    rows += [(100 + i, " ".join(["s1", "s2", "s3", "s4", "s5", "s6"] + [f"v{rng.integers(0, 40)}" for _ in range(3 + i % 30)]))
             for i in range(150)]
    long = [f"u{i}" for i in range(80)]
    rows += [(400 + i, " ".join(long[:i] + [f"x{i}"] + long[i + 1:])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = df.select("doc_id", ngram_join.word_hashes(ngram_join.ascii_lower(df.text)).alias("wh")).mapInArrow(
        ngram_join._sets(5), "doc_id long, n long, sh array<long>")
    ranked = ngram_join._rank(sets, 75)
    sizes = [r.n for r in ranked.select("n").collect()]
    small = ngram_join.boundary(ranked)
    assert min(sizes) <= small < max(sizes)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(df).collect()}
    assert got == expected_join(rows)


def test_embedding_dedup_edge_cases(spark):
    """Tiny and huge components, repeated and null ids, other columns, nulls inside, lengths that differ."""
    rows = [(1, [1e-200, 0.0]), (2, [2e-200, 0.0]), (3, [1e200, 1e200]), (4, [1e200, 1.01e200]), (5, [5e-324, 0.0]), (6, [0.0, 0.0]),
            (7, None), (8, [1.0, None]), (9, [float("inf"), 1.0]), (10, [float("nan"), 1.0]), (11, [1.0, 0.0, 0.0]), (12, []),
            (13, [-1.0, 0.0]), (13, [-1.0, 0.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as rep", "'x' as v", "2 as t")
    out = embedding_dedup.near_dedup(df).collect()
    assert len(out) == len(rows)
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in out}
    alone = {(i, 0, i, True) for i in (6, 7, 8, 9, 10, 11, 12)}
    assert alone <= got and {(1, 2, 1, True), (2, 2, 1, False), (5, 2, 1, False), (3, 1, 3, True), (4, 1, 3, False)} <= got
    assert {r.component_id for r in out if r.vec_id == 13} == {13} and {r.n_links for r in out if r.vec_id == 13} == {1}
    assert {(r.n_links, r.component_id) for r in out if r.vec_id is None} == {(0, None)}


def test_substring_dedup(docs, rows, monkeypatch):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    count = collections.Counter(tuple(w[j:j + 35]) for _, w in words for j in range(len(w) - 34))
    want = collections.Counter()
    for i, w in words:
        covered = [False] * len(w)
        for j in range(len(w) - 34):
            if count[tuple(w[j:j + 35])] > 1:
                covered[j:j + 35] = [True] * 35
        want[i, len(w), sum(covered), " ".join(x for x, c in zip(w, covered, strict=True) if not c)] += 1
    for bucket in (substring_dedup.BUCKET_ROWS, 3):  # 3: most buckets are salted
        monkeypatch.setattr(substring_dedup, "BUCKET_ROWS", bucket)
        got = collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text)
                                  for r in substring_dedup.substring_dedup(docs).collect())
        assert got == want


def test_substring_dedup_repeated_rows_and_null_ids(spark):
    t = " ".join(f"w{i}" for i in range(36))
    d = spark.createDataFrame([(1, t), (1, t), (None, "x " + t), (2, "y")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.substring_dedup(d).collect())
    assert got == [("1", 36, 36, ""), ("1", 36, 36, ""), ("2", 1, 0, "y"), ("None", 37, 36, "x")]


def test_embedding_dedup(spark):
    rng = np.random.default_rng(0)
    v = rng.standard_normal((300, 32))
    v[100:200] = v[:100] + rng.standard_normal((100, 32)) * rng.uniform(0, 0.5, (100, 1))
    v[200:240] = v[0] + rng.standard_normal((40, 32)) * 0.01
    v[240:250] = v[1]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(900, None), (901, [0.0] * 32), (902, [float("nan")] * 32), (903, []), (904, [None, 1.0]), (905, [1.0]), (906, [2.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_dedup(d).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    true = {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(u @ u.T >= 0.9, 1)), strict=True)}
    want = groups(range(300), true)
    degree = collections.Counter(x for p in true for x in p)
    assert sum(got[i].n_links for i in range(300)) >= 0.9 * 2 * len(true)  # recall over random near pairs
    assert all(got[i].n_links <= degree[i] for i in range(300))
    assert all(got[i].component_id == want[i] for i in range(200, 250))
    assert all(got[i].kept and got[i].n_links == 0 for i in (900, 901, 902, 903, 904))
    assert got[905].n_links == 1 and got[906].component_id == 905 and not got[906].kept


def test_embedding_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 7)
    v = np.ones(8) + np.random.default_rng(2).standard_normal((50, 8)) * 0.01
    d = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "vec_id long, embedding array<double>")
    assert all(r.n_links == 49 and r.component_id == 0 for r in embedding_dedup.near_dedup(d).collect())


def test_components_of_a_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in components(e).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_empty(spark, empty):
    assert ngram_join.ngram_join(empty).count() == 0
    assert substring_dedup.substring_dedup(empty).count() == 0
    assert embedding_dedup.near_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
