"""Steps that are worked out once, and the whole corpus behind the ranked word vectors."""

from pyspark.sql import functions as F

from library_data import SF_SMALL
from sentsift.functions import text as tx
from sentsift.operators import clean, models, punkt, vectors
from sentsift.plans import registry


def _plan(spark, name):
    return registry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()


def test_sentence_vectors_deal_sentences_once(spark):
    """One exchange by article; no join of words with their vectors."""
    plan = _plan(spark, "sentence_vectors")
    assert plan.count("RepartitionByExpression") == 1 and "LeftSemi" not in plan


def test_word_vectors_read_the_texts_once(spark):
    assert "Join" not in _plan(spark, "word_vectors")


def test_ranked_vectors_leave_no_token_out(spark):
    texts = spark.createDataFrame([(["b", "a", "b"],), (["c", "d", "a", "b"],), (["e"],)], "tokens array<string>")
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [3.0])], "vec_id long, vec array<double>")
    got = {r.token: r.vec[0] for r in vectors.vocabulary_ranked_vectors(texts, table).collect()}
    assert got == {"b": 1.0, "a": 2.0, "c": 3.0, "d": 1.0, "e": 2.0}


def test_cleaned_texts_are_written_once(spark):
    df = spark.createDataFrame([(1, "mice run", None)], "doc_id long, abstract string, body_text string")
    out = clean.preprocess_corpus(df)
    assert "ExistingRDD" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in out.collect()] == [(1, "mouse run", "")]


def test_trained_split_takes_pieces_and_places_made_before(spark):
    texts = spark.createDataFrame([(1, "Dr. Roe met Dr. Doe. They left. He spoke to Dr. Poe."), (2, None)], "doc_id long, t string")
    counts = punkt.type_counts(texts, "t")
    assert {r.type: (r.with_period, r.without) for r in counts.collect()}["dr"] == (3, 0)
    known = spark.createDataFrame([("dr",)], "type string")
    starters = spark.createDataFrame([("they",)], "type string")
    pieces = texts.select("doc_id", tx.split_sentences("t").alias("p"))
    rows = lambda df: sorted((r.doc_id, tuple(r.sentences)) for r in df.collect())
    got = rows(punkt.split_sentences(pieces, "doc_id", "p", known, starters, punkt.boundaries(pieces, "doc_id", "p")))
    assert got == rows(punkt.split_sentences(texts, "doc_id", "t", known, starters)) and len(got) == 2


def test_encoder_adds_words_up_in_slices(spark, monkeypatch):
    df = spark.range(7).select("id", F.concat(F.lit("word w"), F.col("id").cast("string")).alias("t"))
    rows = lambda: sorted((r.id, tuple(r.vec)) for r in models.embed_documents(df, "id", "t").collect())
    one = rows()
    monkeypatch.setattr(models, "ROWS", 2)
    assert rows() == one and len(one) == 7


def test_article_json_is_packed(spark, tmp_path):
    """Many articles share a file; null and odd ids are kept."""
    import os

    from sentsift.sources import files
    rows = [(i, t, "user", f"say {i} {t}\n") for i in range(200) for t in range(2)] + [(-5, 0, None, None)]
    sf = str(tmp_path)
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{sf}/conversations.parquet")
    bodies = registry._json_bodies(spark, sf)
    assert len(bodies.inputFiles()) < 100
    assert {r.json_path for r in bodies.collect()} == {f"a/{r[0]}.json" for r in rows}
    got = {r.conv_id: r.body_text for r in registry.queries()["read_article_json"](spark, sf).collect()}
    assert len(got) == 201 and got[3] == "user\n\nsay 3 0\nsay 3 1\n\n\n" and got[-5] == "\n\n\n\n"
    one = tmp_path / "one"
    os.makedirs(one)
    (one / "x.json").write_text('{"json_path": "a/1.json", "body_text": [{"section": "S", "text": "t"}]}\n{"json_path": "a/2.json"}\n')
    assert {r.json_path for r in files.read_article_json(spark, str(one), lines=True).collect()} == {"a/1.json", "a/2.json"}


def test_lemma_words_are_read_once(spark):
    assert "Union" not in _plan(spark, "lemma_table")


def test_word_cloud_reads_stored_pairs(spark):
    """The texts are not read again for the result."""
    from sentsift.operators import profile
    df = spark.createDataFrame([("Dogs' tail 42 the dog's 7up dog",), ("Dogs' tail 42 the dog's 7up dog",), (None,)], "t string")
    out = profile.wordcloud_weights(df, "t")
    assert "ExistingRDD" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.word, r["count"]) for r in out.collect()} == {("dogs'", 1), ("tail", 1), ("dog", 2), ("7up", 1)}


def test_java_whitespace_is_the_same_set(spark):
    from sentsift.functions import fixed_values as fv
    c = spark.range(1, 0x3100).select(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    assert c.where(F.col("c").rlike(fv.WS_CLASS) != F.col("c").rlike(fv.WS_JAVA)).count() == 0
    assert c.where(F.col("c").rlike(fv.WS_JAVA)).count() == 29
