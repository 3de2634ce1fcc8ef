"""Trained operators: toxicity, quality, decontamination; and the pipeline."""

import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentsift.llm import decontaminate, quality, toxicity
from sentsift.llm.common import read

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark):
    return read(spark, SF, "documents"), read(spark, SF, "labels")


def test_toxicity_training_holds_no_copies_of_all_words(monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 0)
    monkeypatch.setattr(toxicity, "_calibrate", lambda *_: None)
    rng = np.random.default_rng(1)
    sets = [rng.integers(-2 ** 62, 2 ** 62, 60_000) for _ in range(60)]
    for i, s in enumerate(sets):
        s[:10] = 7 + i % 2
    tracemalloc.start()
    toxicity.train(sets, np.arange(60) % 2, {})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 * sum(s.nbytes for s in sets)


def _peak(run) -> int:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_toxicity_training_takes_a_long_text_alone(monkeypatch):
    """A batch of 64 texts is not widened to its longest one."""
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    monkeypatch.setattr(toxicity, "_calibrate", lambda *_: None)
    sets = [np.full(10, 7 + i % 2, np.int64) for i in range(200)]
    sets[1] = sets[0] = np.tile(np.array([7, 8], np.int64), 15_000)
    assert _peak(lambda: toxicity.train(sets, np.arange(200) % 2, {})) < 60_000_000


def test_toxicity_scoring_holds_a_small_block():
    """Filters of some 16,000 words at once; beside them a few numbers a word."""
    words = np.random.default_rng(1).integers(-2 ** 62, 2 ** 62, 100_000)
    model = toxicity._empty({})
    assert _peak(lambda: model.scores(words, np.arange(0, 100_001, 500))) < 20_000_000


def test_toxicity_held_out(spark, labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs.select("doc_id", "text"), model).join(labels, "doc_id").filter(
        toxicity.held_out(F.col("doc_id"))).collect()
    hit = sum(r.score >= 0.5 for r in out if r.toxic == 1) / sum(r.toxic == 1 for r in out)
    false = sum(r.score >= 0.5 for r in out if r.toxic == 0) / sum(r.toxic == 0 for r in out)
    assert hit > 0.7 and false < 0.02
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 200_000)], "doc_id long, text string")
    assert all(0 <= r.score < 0.5 for r in toxicity.score(odd, model).collect())


def test_toxicity_odd_tables(spark):
    """Repeated rows score alike, clashing columns stay, null ids and labels; the model survives sending."""
    import pickle
    rows = [(i, ("vile scum " if i % 2 else "good day ") * 3 + "word" + "abcdefghij"[i % 10] + "klmnopqrst"[i // 10 % 10] + "uvwxyzabcd"[i // 100 % 10])
            for i in range(1000)]
    docs = spark.createDataFrame(rows + rows[:20] + [(None, "vile scum")], "doc_id long, text string").selectExpr(
        "*", "1 as __tokens", "2 as t", "3 as __id", "4 as label")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1000)] + [(3, None), (None, 1), (99999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    again = pickle.loads(pickle.dumps(model))
    assert (again.tables == model.tables).all() and (again.cuts == model.cuts).all()
    out = toxicity.score(docs, model).collect()
    assert len(out) == 1021 and all(r["__tokens"] == 1 and r["__id"] == 3 for r in out)
    by_text = {}
    for r in out:
        by_text.setdefault(r.text, set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert sum((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in out if r.doc_id is not None) > 0.95 * 1020


def test_toxicity_without_labels(spark, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(empty, none)
    assert toxicity.score(empty, model).count() == 0
    one = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert toxicity.score(one, model).first().score < 0.5


def test_quality_keeps_good_documents(spark, labelled):
    docs, labels = labelled
    out = quality.score(docs, quality.fit(docs, labels), "source", "lang").join(labels, "doc_id").collect()
    assert sum(r.keep for r in out if r.quality == 1) > 0.98 * sum(r.quality == 1 for r in out)
    assert sum(not r.keep for r in out if r.quality == 0) > 0.7 * sum(r.quality == 0 for r in out)


def test_sparse_paths_shrink_to_their_host(spark):
    rows = [("a", "x", 0.9)] * 300 + [("a", "y", 0.0)] + [("b", "x", 0.1)] * 300 + [(None, "z", 0.5)]
    got = {(r["__h"], r["__p"]): r.site for r in quality.site_posteriors(
        spark.createDataFrame(rows, "h string, pt string, p double"), "h", "pt").collect()}
    assert got["a", "x"] > 0.85 and got["b", "x"] < 0.15 and 0.2 < got["a", "y"] < 0.9 and (None, "z") in got


def test_quality_edge_cases(spark, empty):
    d = spark.createDataFrame([(1, None, "s", None), (2, "", None, "p")], "doc_id long, text string, source string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit(d, none) is None
    assert [r.keep for r in quality.score(d, None, "source", "lang").collect()] == [True, True]


def test_decontamination(spark, labelled):
    docs, _ = labelled
    bench = read(spark, SF, "benchmark")
    grams = {}
    for r in bench.collect():
        w = r.text.lower().split()
        for j in range(len(w) - 7):
            grams.setdefault(tuple(w[j:j + 8]), set()).add(r.item_id)
    want = set()
    for r in docs.collect():
        w = r.text.lower().split()
        want |= {(r.doc_id, q) for j in range(len(w) - 7) for q in grams.get(tuple(w[j:j + 8]), ())}
    item = bench.orderBy("item_id").collect()[3].text.split()
    changed = " ".join(w if i % 6 else "changed" for i, w in enumerate(item))
    odd = spark.createDataFrame([(990001, "before " * 30 + changed + " after" * 30), (990002, None), (990003, "")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contamination(docs.select("doc_id", "text").unionByName(odd), bench).collect()}
    assert want <= got and (990001, 3) in got
    assert len(got - want) <= 1 + len(want) // 100


def test_decontamination_without_the_tail(spark, labelled):
    docs, _ = labelled
    bench = read(spark, SF, "benchmark")
    items = [(r.item_id, r.text.split()) for r in bench.orderBy("item_id").collect() if len(r.text.split()) >= 32][:6]
    planted, want = [], set()
    for k, (i, w) in enumerate(items):
        head = w[: -(-len(w) * 17 // 20)]
        reworded = w[: len(w) * 3 // 4] + [f"other{j}" for j in range(len(w) - len(w) * 3 // 4)]
        for j, text in enumerate((head, reworded, w[: -(-len(w) * 7 // 10)])):
            planted.append((991000 + 10 * k + j, " ".join(["before"] * 30 + text + ["after"] * 30)))
            want.add((991000 + 10 * k + j, i))
    odd = spark.createDataFrame(planted, "doc_id long, text string")
    out = decontaminate.contamination(docs.select("doc_id", "text").unionByName(odd), bench).filter("doc_id >= 991000").collect()
    assert want <= {(r.doc_id, r.item_id) for r in out}
    assert all(r.answer is None for r in out)
    told = bench.withColumn("told", F.lit("words that no document has"))
    assert not decontaminate.contamination(odd, told, answer_col="told").count()


def test_decontamination_short_items_and_texts(spark):
    bench = spark.createDataFrame([(1, "Who wrote Faust?"), (2, "What is two plus two"), (3, "how many moons does the planet mars have"),
                                   (4, None), (5, "..."), (6, "who wrote faust")], "item_id long, text string")
    texts = [(1, "ask: who wrote FAUST, and when"), (2, "who really wrote faust"), (3, "what is two plus two"),
             (4, "what is two plus three"), (5, "how many moons does the"), (6, "faust"), (7, None), (8, "two. Who wrote"),
             (9, "faust what is two plus two two")]
    rest = [(100 + k, f"filler{k} words{k % 7} of the text{k % 5} number {k}") for k in range(200)]
    docs = spark.createDataFrame(texts + rest, "doc_id long, text string")
    got = [(r.doc_id, r.item_id) for r in decontaminate.contamination(docs, bench).collect()]
    assert sorted(got) == [(1, 1), (1, 6), (3, 2), (5, 3), (9, 2)]
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()}
    assert kept == {i for i, _ in texts + rest} - {1, 3, 5, 9}


def test_decontamination_empty(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    assert decontaminate.contamination(empty, none).count() == 0
    assert decontaminate.contamination(empty, one).count() == 0


def test_paraphrases_are_found(spark):
    """Every item between 60 foreign words, ordinary and repetitive ones: words replaced, words inserted."""
    items = read(spark, "/root/testdata/sf0.01", "benchmark").orderBy("item_id").collect()
    other = [w for r in read(spark, "/root/testdata/sf0.01", "documents").orderBy("doc_id").limit(60).collect() for w in (r.text or "").split()]
    changes = {"third": lambda w: [f"new{i}" if i % 3 == 2 else x for i, x in enumerate(w)],
               "fifth": lambda w: [f"new{i}" if i % 5 == 4 else x for i, x in enumerate(w)],
               "inserted": lambda w: [y for i, x in enumerate(w) for y in ([x, "plus", "more"] if i % 5 == 4 else [x])]}
    rows, number = [], 0
    for kind, change in changes.items():
        for k, r in enumerate(items):
            for around in ("ordinary", "repetitive"):
                before = other[61 * k: 61 * k + 60] if around == "ordinary" else ["word"] * 60
                rows.append((number, " ".join(before + change(r.text.split()) + before), r.item_id, kind, around))
                number += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, own long, kind string, around string")
    corpus = read(spark, "/root/testdata/sf0.01", "documents").selectExpr("doc_id + 1000000 as doc_id", "text")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contamination(
        docs.select("doc_id", "text").unionByName(corpus), read(spark, "/root/testdata/sf0.01", "benchmark")).collect()}
    for kind in changes:
        own = [r for r in rows if r[3] == kind and r[4] == "ordinary"]
        assert sum((r[0], r[2]) in found for r in own) >= 0.95 * len(own), kind
        own = [r for r in rows if r[3] == kind and r[4] == "repetitive"]
        print(kind, "repetitive", sum((r[0], r[2]) in found for r in own) / len(own))


def test_decontamination_odd_tables(spark):
    """Repeated rows, null ids and clashing columns: every row of a contaminated id goes, null ids stay."""
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "x " + text), (1, "x " + text), (None, text), (2, "clean words here"), (3, None)],
                                 "doc_id long, text string").selectExpr("*", "1 as ids", "2 as item_id", "3 as at")
    bench = spark.createDataFrame([(7, text), (7, text), (None, text), (8, None)], "item_id long, text string").selectExpr("*", "1 as doc_id")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contamination(docs, bench).collect() if r.doc_id} == {(1, 7)}
    left = decontaminate.drop_contaminated(docs, bench).collect()
    assert sorted((r.doc_id or 0, r.ids, r["at"]) for r in left) == [(0, 1, 3), (2, 1, 3), (3, 1, 3)]


def test_lcs():
    assert decontaminate.lcs([1, 2, 3, 2, 4], [2, 3, 9, 4, 1]) == 3
    assert decontaminate.lcs([], [1]) == 0


def test_pipeline(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = read(spark, sf, "documents")
    out = corpus_pipeline.run(spark, sf)
    assert set(docs.columns) <= set(out.columns)
    rows = out.collect()
    assert 0 < len(rows) < docs.count() and len({r.doc_id for r in rows}) == len(rows)
    assert not any(re.search(r"[a-z0-9]@[a-z0-9-]+\.[a-z]", r.text) for r in rows)
    assert all(r.n_chars == len(r.text) and r.n_tokens == len(r.ids) for r in rows)


def test_sums_of_passages_and_windows():
    rng = np.random.default_rng(5)
    for n in (1, 31, 32, 33, 5_000):
        at = np.arange(n) // decontaminate.PASSAGE
        terms, y = rng.integers(0, 50, n), rng.standard_normal((int(at[-1]) + 1, 3)).astype(np.float32)
        exact = np.zeros((50, 3))
        np.add.at(exact, terms, y[at])
        once, sums = decontaminate._sums_by_term(terms, at, y)
        assert np.array_equal(once, np.unique(terms)) and np.allclose(sums, exact[once], atol=1e-4)
        vectors = np.vstack([rng.standard_normal((50, 3)), np.zeros((1, 3))]).astype(np.float32)
        sums = decontaminate._running_sums(vectors, terms)
        for lo in range(0, n, decontaminate.UNIT):
            hi = min(lo + 16, n)
            assert np.allclose(sums[-(-hi // decontaminate.UNIT)] - sums[lo // decontaminate.UNIT], vectors[terms[lo:hi]].sum(axis=0), atol=1e-3)
