"""Sentence ends learned from counts."""

import pytest

from sentsift.operators import punkt

FILLER = ["The river rose again", "Many people came home", "Rain fell over the hills", "Nobody saw the ship leave"]


@pytest.fixture(scope="module")
def texts(spark):
    """Abbreviations never stand without their period; other words end sentences only now and then."""
    rows = []
    for i in range(60):
        f = [FILLER[(i + k) % 4] for k in range(4)]
        rows.append((i, f"{f[0]} as shown in Fig. {i} of the book. {f[1]} with tools, e.g. hammers and saws. {f[2]} near Dr. Smith! {f[3]}."))
    rows += [(100, None), (101, ""), (102, "One."), (103, "What? Yes. " * 400),
             (104, "the book and saws again yes home hills leave " * 120)]
    return spark.createDataFrame(rows, "doc_id long, body string")


@pytest.fixture(scope="module")
def learned(texts):
    counts = punkt.type_counts(texts, "body").persist()
    known = punkt.abbreviations(counts)
    return counts, known, punkt.sentence_starters(punkt.boundaries(texts, "doc_id", "body"), counts, known)


def test_abbreviations(learned):
    found = {r.type for r in learned[1].collect()}
    assert {"fig", "e.g", "dr"} <= found and not found & {"book", "saws", "again", "home", "hills", "yes", "##"}


def test_abbreviations_do_not_end_sentences(texts, learned):
    _, known, starters = learned
    got = {r.doc_id: r.sentences for r in punkt.split_sentences(texts, "doc_id", "body", known, starters).collect()}
    assert got[0] == ["The river rose again as shown in Fig. 0 of the book.", "Many people came home with tools, e.g. hammers and saws.",
                      "Rain fell over the hills near Dr. Smith!", "Nobody saw the ship leave."]
    assert got[100] == [""] and got[101] == [""] and got[102] == ["One."]
    assert got[103][:4] == ["What?", "Yes.", "What?", "Yes."] and len(got[103]) in (800, 801)


def test_a_starter_ends_the_sentence_after_an_abbreviation(spark):
    known = spark.createDataFrame([("fig",)], "type string")
    starters = spark.createDataFrame([("the",)], "type string")
    df = spark.createDataFrame([(1, "See Fig. The end. See Fig. the end. See Fig. Two.")], "doc_id long, body string")
    got = punkt.split_sentences(df, "doc_id", "body", known, starters).first().sentences
    assert got == ["See Fig.", "The end.", "See Fig. the end.", "See Fig. Two."]


def test_empty_corpus(spark, texts):
    counts = punkt.type_counts(texts.limit(0), "body")
    known = punkt.abbreviations(counts)
    assert known.count() == 0
    assert punkt.sentence_starters(punkt.boundaries(texts.limit(0), "doc_id", "body"), counts, known).count() == 0
