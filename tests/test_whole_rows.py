"""Forms that move fewer rows hold the same values as the plain ones, with null and repeated keys."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sentsift.functions import fixed_values as fv
from sentsift.functions import text as tx
from sentsift.operators import clean, rank, retrieve, scoring, vectors
from sentsift.operators import paragraph_vectors as pv


def test_scores_by_sentence_hold_every_score(spark, monkeypatch):
    """Several question blocks and groups, an article without a number and one that comes twice."""
    st = spark.createDataFrame([(d, p, 3, ["alpha", "beta", "gamma"][: p + 1]) for d in (1, 2, None, 2) for p in range(3)] +
                               [(5, 0, 1, [])], "doc_id long, pos int, n_sent int, tokens array<string>")
    qt = spark.createDataFrame([(7, ["alpha", "beta"]), (8, []), (9, ["gamma", "delta"])], "q_id long, tokens array<string>")
    monkeypatch.setattr(scoring, "QUESTIONS", 2)
    monkeypatch.setattr(scoring, "GROUP", 4)
    plain = retrieve.similarity_matrix(st, qt, vectors.HashedVectors())
    held = retrieve.similarity_matrix(st, qt, vectors.HashedVectors(), by_sentence=True)
    flat = held.select("doc_id", "pos", F.explode(F.arrays_zip("q_id", "score")).alias("x")).select("doc_id", "x.q_id", "pos", "x.score")
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, flat.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)
    unit = F.round(F.col("score") * 10 ** fv.SCORE_DECIMALS).cast("long")
    sums = plain.groupBy("doc_id", "pos").agg(F.count("q_id"), F.count(F.when(F.col("score") == 0, 1)), F.max("score"), F.min("score"),
                                              F.sum(unit), F.sum((F.col("q_id") + 1) * unit))
    got = scoring.sums_by_sentence(held, fv.SCORE_DECIMALS)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, sums.collect()), key=key)
    assert {r.n_questions for r in got.collect()} == {3, 6}
    with pytest.raises(ValueError):
        retrieve.similarity_matrix(st, qt, vectors.HashedVectors(), by_sentence=True, top_k=2)


def test_every_group_has_a_partition(spark, monkeypatch):
    """By hash several groups fell into one partition and waited for each other."""
    monkeypatch.setattr(scoring, "GROUP", 10)
    st = spark.range(200).select(F.col("id").alias("doc_id"), F.lit(0).alias("pos"), F.lit(1).alias("n_sent"),
                                 F.array(F.lit("alpha")).alias("tokens"))
    qt = spark.createDataFrame([(1, ["alpha"])], "q_id long, tokens array<string>")
    m = retrieve.similarity_matrix(st, qt, vectors.HashedVectors())
    groups = m.select(F.spark_partition_id().alias("p"), F.pmod(F.xxhash64("doc_id"), F.lit(20)).alias("g")).distinct().collect()
    assert len({r.p for r in groups}) == len({r.g for r in groups}) == len(groups)


def test_a_text_is_cleaned_once(spark):
    """A cleaning step that mentions its text twice does not work it out twice."""
    d = spark.createDataFrame([("a",)], "t string")
    for step in (tx.replace_math, tx.replace_urls, tx.expand_contractions):
        plan = d.select(step(F.regexp_replace("t", "once", " ")).alias("o"))._jdf.queryExecution().analyzed().toString()
        assert plan.count("once") == 1, step


def test_mean_vectors_move_once_a_block(spark, monkeypatch):
    """Null and repeated keys, null and unknown tokens, a token with two vectors, several blocks; no join of rows with vectors."""
    monkeypatch.setattr(rank, "BLOCK", 5)
    rows = [(1, "a", ["x", "y", "x"]), (1, "a", ["z"]), (None, "a", ["x"]), (None, None, ["y", None]), (2, "b", ["unknown"]),
            (3, "b", []), (4, "b", None), (5, "c", ["w", "x"])] + [(k, "d", ["x", "y"]) for k in range(10, 30)]
    df = spark.createDataFrame(rows, "k long, s string, tokens array<string>")
    known = {"x": [[1.0, 0.0]], "y": [[0.0, 1.0]], "z": [[2.0, 2.0]], "w": [[1.0, 1.0], [3.0, -1.0]]}
    vocab = spark.createDataFrame([(t, v) for t, vs in known.items() for v in vs], "token string, vec array<double>")
    expected = {}
    for k, s, tokens in rows:
        expected.setdefault((k, s), []).extend(v for t in tokens or [] for v in known.get(t, []))
    expected = {k: tuple(sum(x) / len(vs) for x in zip(*vs, strict=True)) for k, vs in expected.items() if vs}
    out = rank.mean_vector(df, vocab, ["k", "s"])
    got = out.collect()
    assert len(got) == len(expected) and {(r.k, r.s): tuple(r.vec) for r in got} == expected
    assert rank.mean_vector(df.limit(0), vocab, ["k"]).count() == 0 and rank.mean_vector(df, vocab.limit(0), ["k"]).count() == 0
    # A vector reaches the rows of a block once: 4 rows of the vocabulary and at most 4 tokens a block are joined.
    blocks = rank._tokens_of_blocks(iter([pa.RecordBatch.from_arrays(
        [pa.array([0, 0, 1], pa.int32()), pa.array([1, 2, 3]), pa.array([["x", "y"], ["x"], ["x", None]])], names=["_block", "k", "_tokens"])]))
    assert [b.to_pydict() for b in blocks] == [{"_block": [0, 0], "token": ["x", "y"]}, {"_block": [1, 1], "token": ["x", None]}]


def test_tokens_of_a_task_are_told_apart_before_they_move(spark):
    lists = spark.createDataFrame([(["x", "y", "x", None],)] * 500 + [([],), (None,)], "tokens array<string>").coalesce(1)
    rows = [r.token for r in vectors.batch_tokens(lists).collect()]
    assert sorted(rows, key=str) == [None, "x", "y"]


def test_passing_tables_are_deleted(spark, tmp_path):
    """Cleaned texts and lemmas are read no more once the corpus is written; null texts and other columns stay."""
    docs = spark.createDataFrame([(1, "The mice run", None), (2, None, "two  boxes\tof mice")], "doc_id long, abstract string, body_text string")
    nouns = spark.createDataFrame([("box",)], "word string")
    passing = []
    clean.preprocess_corpus(docs, nouns, passing=passing).write.parquet(str(tmp_path / "out"))
    assert len(passing) == 2 and all(os.path.exists(p) for p in passing)
    got = {r.doc_id: (r.preprocessed_abstract, r.preprocessed_body_text) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: ("the mouse run", ""), 2: ("", "two box mouse")}
    clean.discard(spark, passing)
    assert not any(os.path.exists(p) for p in passing)
    more = clean.apply_lemmas(docs.withColumn("n", F.lit(5)), "doc_id", {"body_text": "b"}, spark.createDataFrame([("mice", "mouse")], "word string, lemma string"))
    assert more.columns == ["doc_id", "b", "abstract", "n"]
    assert {(r.doc_id, r.b, r.n) for r in more.collect()} == {(1, "", 5), (2, "two boxes of mouse", 5)}


def test_runs_are_added_up_as_numpy_does():
    """Sums of runs of any length are those of ``reduceat`` to the last bit, sorted rows or not, and inputs stay as they were."""
    rng = np.random.default_rng(0)
    for sizes in ([1] * 50, [*range(1, 30), 200, 1, 1], [2, 2, 3], [300]):
        values = rng.normal(size=(sum(sizes), 33)).astype(np.float32)
        first = np.cumsum(sizes) - np.array(sizes)
        wanted = np.add.reduceat(values, first, axis=0)
        assert (pv._sums_of_runs(values, first) == wanted).all()
        rows, before = np.repeat(np.arange(len(sizes)), sizes), values.copy()
        for order in (np.arange(len(rows)), rng.permutation(len(rows))):
            sums = np.zeros((len(sizes), 33), np.float32)
            pv._add(sums, rows[order], values[order])
            assert np.allclose(sums, wanted, atol=1e-4)
        pv._add(np.zeros((len(sizes), 33), np.float32), rows, values)
        assert (values == before).all()
