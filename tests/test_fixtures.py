"""Hand-worked rows (FIXTURES.md §3)."""

import math

import pytest
from pyspark.sql import functions as F

from sentsift.functions import text as tx
from sentsift.operators import clean, prepare, profile, retrieve, terms, vectors
from sentsift.sources import files

SMALL_STOPS = ["the", "of", "and", "in", "to", "is"]


def one(spark, value, name="t"):
    return spark.createDataFrame([(value,)], f"{name} string")


def test_f1_assemble_body(spark):
    parts = spark.createDataFrame([(1, 0, "A", "x1"), (1, 1, "B", "y"), (1, 2, "A", "x2")],
                                  "k long, pos int, section string, text string")
    out = files.assemble_body(parts, "k", "pos", "section", "text").collect()
    assert out[0]["body_text"] == "A\n\nx1x2\n\nB\n\ny\n\n"


@pytest.mark.parametrize("text,expected", [
    ("See Fig.2 and 0.05", "See Fig.2 and 0.05"),
    ("See Fig.2 and http://a.org/x?y=1 now", "See URL and URL now"),
    ("www.a.org, p=0.05", "URL, URL"),
    ("https://a.org:80/x&y", "URL:80/x&y"),
])
def test_f2_replace_urls(spark, text, expected):
    assert one(spark, text).select(tx.replace_urls("t").alias("o")).first()["o"] == expected


def test_f3_expand_contractions(spark):
    out = one(spark, "They’re late, I can't").select(tx.expand_contractions("t").alias("o")).first()["o"]
    assert out == "They' are late, I cannot"  # the fixture's value, with the table's typo


def test_expand_every_contraction(spark):
    """Every key alone, and case that is not listed stays."""
    rows = [(k, v) for k, v in tx.fv.CONTRACTIONS.items()] + [("CoULDN'T", "CoULDN'T"), ("he've", "he've")]
    out = spark.createDataFrame(rows, "t string, v string").select(tx.expand_contractions("t").alias("o"), "v")
    assert len(rows) == 198 and out.filter("o <> v").count() == 0


@pytest.mark.parametrize("text,expected", [
    ("The model's [math]x^2[math] is 0.5; the viruses_a", "the model s math equation 0 5 viruses a"),
    ("a uf6dc b", "a b"),
])
def test_f4_clean_text(spark, text, expected):
    out = one(spark, text).select(tx.clean_text_no_lemma("t", stopwords=SMALL_STOPS).alias("o")).first()["o"]
    assert out == expected


def test_f5_bigrams(spark):
    df = one(spark, "The cat of the house sat")
    words = df.select(tx.words_for_ngrams("t", SMALL_STOPS).alias("w"))
    out = words.select(tx.ngrams(F.col("w"), 2).alias("g")).first()["g"]
    assert out == ["cat house", "house sat"]


def test_f6_split_sentences(spark):
    out = one(spark, "Masks work [12]. Cases fell (3). f() a***b").select(
        tx.split_sentences("t").alias("s")).first()["s"]
    assert out == ["Masks work .", "Cases fell .", "f a", "b"]


def test_f7_tokenize_sentence(spark):
    s = "The 12 viruses, e.g. SARS shown in fig. 2 were... spread."
    out = one(spark, s).select(tx.tokenize_sentence(tx.normalize_sentence("t"), ["the"]).alias("o")).first()["o"]
    assert out == ["viruses", "e.g.", "sars", "were", "...", "spread"]


def test_f8_weighted_vector_and_idf(spark):
    rows = [(0, "a", 2, 1, [1.0, 0.0]), (0, "b", 1, 2, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "s int, token string, cnt long, df long, vec array<double>")
    w = vectors.term_frequency(df, ["s"]).withColumn("w", F.col("tf") * vectors.inverse_doc_frequency(F.lit(4), "df"))
    out = vectors.weighted_sentence_vector(w, ["s"]).first()
    assert out["weight_sum"] == pytest.approx(0.557992, abs=1e-6)
    assert out["vec"] == pytest.approx([0.828144, 0.171856], abs=1e-6)
    idf = spark.createDataFrame([(d,) for d in [1, 2, 3, 4]], "df long").select(
        vectors.inverse_doc_frequency(F.lit(4), "df").alias("i")).collect()
    assert [r["i"] for r in idf] == pytest.approx([0.693147, 0.287682, 0.0, -0.223144], abs=1e-6)


def test_f9_top_relevant_sentences(spark):
    rows = [(0, 0, "s1", .9), (0, 0, "s2", .5), (0, 0, "s3", .4), (0, 0, "s4", .3), (0, 0, "s5", .2),
            (0, 0, "s6", .1), (0, 1, "s1", .7), (0, 1, "s6", .45), (0, 1, "s2", .1)]
    df = spark.createDataFrame(rows, "doc_id long, q_id long, sentence string, score double")
    df = df.withColumn("pos", F.substring("sentence", 2, 1).cast("int"))
    top = retrieve.top_per_group(df, ["doc_id", "q_id"], "score", 5, ["pos"])
    out = sorted((r["sentence"], r["score"]) for r in retrieve.dedup_threshold(top, 0.4).collect())
    assert out == [("s1", .9), ("s2", .5), ("s6", .45)]


def test_f10_duplicate_counts(spark):
    rows = [("t", "a", "b"), ("t", "a", "b"), ("t", None, "b"), ("t", None, "b"), ("u", "a", "b")]
    df = spark.createDataFrame(rows, "title string, abstract string, body_text string")
    out = {r["is_duplicate"]: r["count"] for r in profile.duplicate_counts(df, df.columns).collect()}
    assert out == {True: 2, False: 3}


def test_f11_symbol_inventory(spark):
    out = {r["symbol"] for r in terms.symbol_inventory(one(spark, "a, b--c é_d (e)"), "t").collect()}
    assert out == {" ", " (", ")", ", ", "--"}


def test_f12_read_metadata(spark, tmp_path):
    p = tmp_path / "meta.csv"
    p.write_text('cord_uid,title,abstract\n1,"multi\nline, ""q""",NA\n2,x,\n', encoding="utf-8")
    rows = {r["cord_uid"]: r for r in files.read_metadata(spark, str(p)).collect()}
    assert rows["1"]["title"] == 'multi\nline, "q"'
    assert rows["1"]["abstract"] is None and rows["2"]["abstract"] is None


def test_f13_lemmatize(spark):
    words = ["viruses", "studies", "dogs", "churches", "boxes", "women", "glass", "running", "wolves"]
    lemmas = ["virus", "study", "dog", "church", "box", "woman", "glass", "running", "wolf"]
    df = spark.createDataFrame([(1, " ".join(words))], "k long, t string")
    vocab = spark.createDataFrame([(w,) for w in lemmas], "word string")
    out = clean.lemmatize(df, "k", "t", "o", vocab).first()["o"]
    assert out.split() == lemmas


def test_sample_n_repeatable(spark):
    df = spark.range(100).withColumn("k", F.col("id").cast("string"))
    a = [r["k"] for r in prepare.sample_n(df, 10, "k", "s").collect()]
    b = [r["k"] for r in prepare.sample_n(df, 10, "k", "s").collect()]
    assert a == b and len(a) == 10
    assert prepare.sample_n(df, 1000, "k").count() == 100


def test_ngram_count_property(spark):
    texts = ["", "one", "one two", "alpha beta gamma delta", "a b c d e f g"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    w = df.select(tx.words_for_ngrams("t", []).alias("w"))
    for r in w.select(F.size("w").alias("n"), F.size(tx.ngrams(F.col("w"), 2)).alias("b"),
                      F.size(tx.ngrams(F.col("w"), 3)).alias("c")).collect():
        assert r["b"] == max(r["n"] - 1, 0) and r["c"] == max(r["n"] - 2, 0)


def test_cosine_range(spark):
    import random
    rnd = random.Random(3)
    rows = [([rnd.uniform(-1, 1) for _ in range(8)], [rnd.uniform(-1, 1) for _ in range(8)]) for _ in range(50)]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    for r in df.select(vectors.cosine("a", "b").alias("c")).collect():
        assert -1.0 - 1e-12 <= r["c"] <= 1.0 + 1e-12 and not math.isnan(r["c"])


@pytest.mark.parametrize("text,expected", [
    ("x [math]a[math] y [math]b math] z", "x MATH EQUATION y MATH EQUATION z"),
    ("[math]a\nb math] end", "[math]a\nb math] end"),
    ("no tag here math]", "no tag here math]"),
])
def test_replace_math(spark, text, expected):
    assert one(spark, text).select(tx.replace_math("t").alias("o")).first()["o"] == expected


def test_small_preparation_operators(spark):
    df = spark.createDataFrame([("3", "0.7", "a;b"), ("1", "x", "c"), ("2", "0.2", None)],
                               "k string, s string, p string")
    idx = {r["k"]: r["index"] for r in prepare.add_row_index(df, ["k"]).collect()}
    assert idx == {"1": 0, "2": 1, "3": 2}
    parsed = {r["k"]: r["v"] for r in df.select("k", prepare.parse_number("s").alias("v")).collect()}
    assert parsed == {"3": 0.7, "1": None, "2": 0.2}
    kept = prepare.score_threshold(df.select("k", prepare.parse_number("s").alias("score")), 0.2)
    assert [r["k"] for r in kept.collect()] == ["3"]
    assert prepare.drop_columns(df, ["s", "p"]).columns == ["k"]
    assert [r["f"] for r in df.select(prepare.first_of_list("p").alias("f")).orderBy("k").collect()] == \
        ["c", None, "a"]
    assert prepare.drop_null_key(df, ["p"]).count() == 2


def test_publications_split_and_granularity(spark):
    df = spark.createDataFrame([("a; b", "2020-01-03"), ("b", "2020-01-20"), ("c;a", "2020-02-01")],
                               "authors string, publish_time string")
    by_author = {r["value"]: r["count"] for r in profile.publications_by(df, "authors", split=";").collect()}
    assert by_author == {"a": 2, "b": 2, "c": 1}
    by_month = {r["value"]: r["count"] for r in
                profile.publications_by(df, "publish_time", granularity="month").collect()}
    assert by_month == {"2020-01-01": 2, "2020-02-01": 1}
