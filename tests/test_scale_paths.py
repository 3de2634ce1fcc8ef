"""Block sizes, vector formats and partial sums change the plan only, never the rows."""

from pyspark.sql import functions as F

from library_data import SF_SMALL
from sentsift.functions import text as tx
from sentsift.operators import clean, rank, retrieve, scoring, vectors
from sentsift.plans import corpus
from sentsift.sources import tables


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_lemmas_depend_on_the_vocabulary_alone(spark):
    """Exceptions, rules, ties and unknown words; another document changes nothing."""
    nouns = spark.createDataFrame([(w,) for w in ["virus", "study", "box", "glass", "gla", "dog", "wolf", "basis"]], "word string")
    rows = [(1, "mice children analyses criteria  studies viruses boxes glass glasses dogs", "wolves xyzs dog"), (2, None, "bases"),
            (3, "", None), (4, "mice", "mice mice")]
    df = spark.createDataFrame(rows, "doc_id long, a string, b string")
    words = df.select(F.explode(tx.split_ws(F.concat_ws(" ", "a", "b"))).alias("word"))
    out = lambda d: {r.doc_id: (r.x, r.y) for r in clean.apply_lemmas(
        d, "doc_id", {"a": "x", "b": "y"}, clean.lemma_table(words, nouns)).collect()}
    expected = {1: ("mouse child analysis criterion study virus box gla glass dog", "wolf xyzs dog"), 2: ("", "basis"), 3: ("", ""),
                4: ("mouse", "mouse mouse")}
    expected[1] = (expected[1][0].replace("gla ", "glass "), expected[1][1])
    got = out(df)
    assert got == expected
    more = df.unionByName(spark.createDataFrame([(9, "glas dogsy", "stud")], df.schema))
    assert {k: v for k, v in out(more).items() if k != 9} == expected
    assert clean.lemma_table(words, None).where("word = 'dogs'").count() == 0


def _word_lists(spark, packed):
    """The hashed vectors as arrays of doubles."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            rows = [list(r) for r in vectors.matrix(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["token", "vec"])
    return packed.mapInArrow(run, "token string, vec array<double>")


def test_mean_vector_of_packed_and_plain_vectors(spark):
    st = corpus.sentence_tokens(spark, SF_SMALL)
    wv = corpus.word_vectors(spark, SF_SMALL, st)
    docs = tables.articles(spark, SF_SMALL).select("doc_id", tx.split_ws(F.lower("body_text")).alias("tokens"))
    r = lambda df: sorted((x["doc_id"], tuple(round(v, 9) for v in x["vec"])) for x in df.collect()
                          if x["vec"] is not None)
    b = r(rank.mean_vector(docs, wv, ["doc_id"]))
    j = r(rank.mean_vector(docs, _word_lists(spark, wv), ["doc_id"]))
    assert b == j and b


def test_blocks_of_any_size_give_the_same_rows(spark, monkeypatch):
    """Many blocks of questions, groups of sentences and buckets of positions against one of each."""
    st = corpus.sentence_tokens(spark, SF_SMALL)
    qt = corpus.question_tokens(spark, SF_SMALL)
    wv = corpus.word_vectors(spark, SF_SMALL, st)
    cols = ["doc_id", "sentence", "score"]
    one = _rows(retrieve.relevant_sentences(st, qt, wv), cols)
    monkeypatch.setattr(scoring, "QUESTIONS", 7)
    monkeypatch.setattr(scoring, "GROUP", 900)
    assert _rows(retrieve.relevant_sentences(st, qt, wv, bucket_size=5), cols) == one and one
    assert _rows(retrieve.relevant_sentences(st, qt, _word_lists(spark, wv)), cols) == one


def test_matrix_holds_every_sentence_and_question(spark):
    st = spark.createDataFrame([(1, 0, 3, ["alpha", "beta"]), (1, 1, 3, []), (1, 2, 3, ["alpha"]), (2, 0, 1, ["unknown"]),
                                (3, 0, 2, ["gamma"]), (3, 1, 2, ["gamma"])], "doc_id long, pos int, n_sent int, tokens array<string>")
    qt = spark.createDataFrame([(7, ["alpha", "beta"]), (8, []), (9, ["unknown"])], "q_id long, tokens array<string>")
    wv = spark.createDataFrame([("alpha", [1.0, 0.0]), ("beta", [0.0, 1.0]), ("gamma", [1.0, 1.0])], "token string, vec array<double>")
    got = {(r.doc_id, r.pos, r.q_id): r.score for r in retrieve.similarity_matrix(st, qt, wv, weighting="mean").collect()}
    assert set(got) == {(d, p, q) for d, p in ((1, 0), (1, 1), (1, 2), (2, 0), (3, 0), (3, 1)) for q in (7, 8, 9)}
    assert {k: v for k, v in got.items() if v} == {(1, 0, 7): 1.0, (1, 2, 7): 0.707107, (3, 0, 7): 1.0, (3, 1, 7): 1.0}
    top = retrieve.relevant_sentence_scores(st, qt, wv, top_k=2, weighting="mean").collect()
    assert sorted((r.q_id, r.pos) for r in top if r.doc_id == 1) == [(7, 0), (7, 2), (8, 0), (8, 1), (9, 0), (9, 1)]
    assert retrieve.similarity_matrix(st, qt.limit(0), wv).count() == 0
    assert retrieve.similarity_matrix(st.limit(0), qt, wv).count() == 0
    assert {r.score for r in retrieve.similarity_matrix(st, qt, wv.limit(0)).collect()} == {0.0}


def test_many_questions_over_few_articles(spark):
    """30,000 questions in 118 blocks; nothing is collected and nothing refused."""
    st = spark.createDataFrame([(d, p, 4, ["alpha", "beta"][: p % 3]) for d in range(3) for p in range(4)],
                               "doc_id long, pos int, n_sent int, tokens array<string>")
    qt = spark.range(30_000).select(F.col("id").alias("q_id"), F.when(F.col("id") % 2 == 0, F.array(F.lit("alpha")))
                                    .otherwise(F.array(F.lit("beta"), F.concat(F.lit("t"), "id"))).alias("tokens"))
    tokens = qt.select(F.explode("tokens").alias("token")).unionByName(st.select(F.explode("tokens").alias("token")))
    m = retrieve.similarity_matrix(st, qt, vectors.hashed_vectors(tokens))
    assert m.count() == 12 * 30_000 and m.select("q_id").distinct().count() == 30_000


def test_weighted_vectors_with_and_without_partial_sums(spark):
    rows = [(k % 5 if k % 7 else None, f"k{k % 3}", float(k % 4) - 1.0, [float(k), 1.0, -float(k) / 2]) for k in range(200)]
    rows += [(99, "zero", 1.0, [1.0, 2.0, 3.0]), (99, "zero", -1.0, [3.0, 2.0, 1.0])]
    df = spark.createDataFrame(rows, "a int, b string, w double, vec array<double>")
    expected = {}
    for a, b, w, v in rows:
        total, acc = expected.get((a, b), (0.0, [0.0] * 3))
        expected[a, b] = (total + w, [x + w * y for x, y in zip(acc, v, strict=True)])
    for combine in (True, False):
        got = {(r.a, r.b): (r.weight_sum, r.vec) for r in
               vectors.weighted_sentence_vector(df.repartition(7), ["a", "b"], combine=combine).collect()}
        assert set(got) == set(expected)
        for key, (total, acc) in expected.items():
            assert abs(got[key][0] - total) < 1e-9
            if abs(total) < 1e-9:
                assert got[key][1] is None
            else:
                assert all(abs(x - y / total) < 1e-9 for x, y in zip(got[key][1], acc, strict=True))
    assert len(vectors.weighted_sentence_vector(df, []).collect()) == 1
