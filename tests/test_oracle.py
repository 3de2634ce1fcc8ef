"""Registered queries against their DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from library_data import SF_SMALL
from sentsift.plans import registry
from sentsift.sources.tables import TABLES

FAST = ["read_articles", "assemble_body", "first_of_list", "drop_any_null", "sample_n", "corpus_build",
        "null_counts", "schema_profile", "duplicate_counts", "duplicate_flags", "publications_by_date",
        "publications_by_month", "date_extremes", "wordcloud_title", "top_bigrams_abstract_raw",
        "symbols_body", "clean_text_pages", "replace_urls_pages", "split_sentences", "tokenize_sentence",
        "word_vectors", "document_frequency", "rank_documents", "top10_articles", "relevant_sentences",
        "lemma_table", "sentence_vectors", "similarity_matrix", "top5_per_question", "document_tokens", "nearest_documents",
        "read_metadata", "write_articles", "read_article_json", "missing_bodies", "drop_columns", "drop_null_key", "add_row_index",
        "parse_number", "replace_math", "expand_contractions", "question_explode", "abbreviations", "split_sentences_trained",
        "preprocess_corpus", "wordcloud_body_text"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return round(v, 5) + 0.0 if not math.isnan(v) else "nan"
    return v


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    s = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = {c: i for i, c in enumerate(dcols)}
    d = sorted((tuple(norm(r[idx[c]]) for c in cols) for r in cur.fetchall()), key=repr)
    assert s == d


def test_every_query_has_oracle_or_is_marked():
    q, o = registry.queries(), registry.oracle_sql()  # the training-data queries have tests of their own
    assert set(o) <= set(q)
    rows_only = set(q) - set(o)
    assert rows_only <= {"sentence_embedding_model", "mean_vector_similarity", "document_embedding_model",
                         "document_embedding_model_abstract", "embed_documents", "rank_documents_encoder", "nearest_vectors_index"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["doc_id", "sentence", "score"]
