"""Article JSON, Parquet hand-over, reuse-or-build, question slicing."""

import json

from pyspark.sql import functions as F

from sentsift.operators import sentences
from sentsift.sources import files


def test_article_json_corpus_build(spark, tmp_path):
    root = tmp_path / "json"
    (root / "a").mkdir(parents=True)
    bodies = {"a/1.json": [{"section": "Intro", "text": "x1"}, {"section": "M", "text": "y"},
                           {"section": "Intro", "text": "x2"}],
              "a/2.json": [{"section": "S", "text": "z"}]}
    for rel, parts in bodies.items():
        (root / rel).write_text(json.dumps({"paper_id": rel, "body_text": parts}), encoding="utf-8")
    meta = spark.createDataFrame(
        [("1", "t1", "ab1", "a/1.json; b/1.json", "x"), ("2", "t2", "ab2", "a/2.json", "y"),
         ("3", "t3", None, "a/3.json", "z"), ("4", "t4", "ab4", None, "w")],
        "cord_uid string, title string, abstract string, pdf_json_files string, sha string")
    out = files.build_corpus(meta, files.read_article_json(spark, str(root)), 100)
    got = {r["cord_uid"]: r["body_text"] for r in out.collect()}
    assert got == {"1": "Intro\n\nx1x2\n\nM\n\ny\n\n", "2": "S\n\nz\n\n"}
    assert "sha" not in out.columns


def test_write_read_and_reuse(spark, tmp_path):
    df = spark.range(5).withColumn("t", F.concat(F.lit("a,\"b\"\n"), F.col("id").cast("string")))
    for fmt in ["parquet", "csv"]:
        p = str(tmp_path / f"t_{fmt}")
        files.write_table(df, p, fmt)
        back = files.read_table(spark, p, fmt)
        assert sorted(r["t"] for r in back.collect()) == sorted(r["t"] for r in df.collect())
    calls = []

    def build():
        calls.append(1)
        return df
    p = str(tmp_path / "reuse")
    assert files.reuse_or_build(spark, p, build).count() == 5
    assert files.reuse_or_build(spark, p, build).count() == 5
    assert len(calls) == 1


def test_question_slices(spark):
    q = spark.createDataFrame([(i, f"q{i}") for i in range(5)], "q_id long, question string")
    assert [r["q_id"] for r in sentences.question_explode(q, 1, 3).orderBy("q_id").collect()] == [1, 2]
    p = sentences.question_prefix(q.where("q_id = 2"), "G?").orderBy("q_id").collect()
    assert [(r["q_id"], r["question"]) for r in p] == [(4, "G?"), (5, "q2")]


def test_read_word_vectors(spark, tmp_path):
    p = str(tmp_path / "wv")
    spark.createDataFrame([("a", [1.0, 2.0]), ("b", [0.5, -1.0])], "token string, vec array<float>") \
        .write.parquet(p)
    out = {r["token"]: r["vec"] for r in files.read_word_vectors(spark, p).collect()}
    assert out == {"a": [1.0, 2.0], "b": [0.5, -1.0]}


def test_preprocessed_corpus_is_stored_once(spark):
    from library_data import SF_SMALL
    from sentsift.operators import clean
    from sentsift.plans import corpus
    from sentsift.sources import tables
    a = corpus.preprocessed(spark, SF_SMALL)
    b = corpus.preprocessed(spark, SF_SMALL)      # read back from the shared folder
    fresh = clean.preprocess_corpus(tables.articles(spark, SF_SMALL), corpus.nouns(spark, SF_SMALL))
    rows = lambda df: sorted(tuple(r) for r in df.select(
        "doc_id", "preprocessed_abstract", "preprocessed_body_text").collect())
    assert rows(a) == rows(b) == rows(fresh)
    assert "preprocessed-" in b.inputFiles()[0]


def test_article_json_of_escaped_names_and_qualified_roots(spark, tmp_path):
    root = tmp_path / "json root+1"
    (root / "a b").mkdir(parents=True)
    for name in ("a b/x y.json", "a b/50%.json", "a b/p+q.json"):
        (root / name).write_text(json.dumps({"paper_id": name, "body_text": [{"section": "S", "text": name}]}), encoding="utf-8")
    for given in (str(root), f"file:{root}", f"file://{root}/"):
        got = {r.json_path for r in files.read_article_json(spark, given).collect()}
        assert got == {"a b/x y.json", "a b/50%.json", "a b/p+q.json"}, given


def test_metadata_keeps_odd_records(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text('a,b\n1," x ""q""\nline "\nNA,nan\n2\n3,4,5\n', encoding="utf-8")
    rows = files.read_metadata(spark, str(p), ["a", "b"], rescued="_bad").collect()
    got = {(r.a, r.b, r["_bad"] is not None) for r in rows}
    assert ("1", ' x "q"\nline ', False) in got and (None, None, False) in got and len(rows) == 4
    assert sum(r["_bad"] is not None for r in rows) == 2
    assert files.read_metadata(spark, str(p), ["a", "b"]).columns == ["a", "b"]


def test_missing_bodies_are_counted(spark):
    meta = spark.createDataFrame([("1", "a/1.json; b/1.json"), ("2", "a/2.json"), ("3", "a/3.json")], "cord_uid string, pdf_json_files string")
    bodies = spark.createDataFrame([("a/1.json", "x"), ("a/3.json", "y")], "json_path string, body_text string")
    assert [r.cord_uid for r in files.missing_bodies(meta, bodies).collect()] == ["2"]


def test_row_index_by_ranges(spark):
    from sentsift.operators import prepare
    rows = [(None if i % 50 == 7 else f"k{i * 7919 % 301:03d}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, i long")
    expected = {i: n for n, (_, i) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])))}
    for ranges in (1, 2, 64):
        got = {r.i: r["index"] for r in prepare.add_row_index(df, ["k", "i"], ranges=ranges).collect()}
        assert got == expected
    assert prepare.add_row_index(df.limit(0), ["k"]).columns == ["k", "i", "index"]


def test_shared_folder_is_asked_for_on_a_cluster(monkeypatch):
    import types

    import pytest

    from sentsift import session
    conf = types.SimpleNamespace(get=lambda k, d=None: d)
    sc = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(types.SimpleNamespace(conf=conf, sparkContext=sc))
