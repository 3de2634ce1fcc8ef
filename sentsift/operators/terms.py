"""Term statistics: n-grams, top terms, symbol inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentsift.functions import fixed_values as fv
from sentsift.functions import text as tx


def ngram_rows(df: DataFrame, col: str, n: int, stopwords=None) -> DataFrame:
    """One row per n-gram: lower-cased whitespace words without stop words,
    adjacent pairs/triples taken after the removal, never across rows."""
    words = df.select(tx.words_for_ngrams(F.coalesce(F.col(col), F.lit("")), stopwords).alias("_w"))
    return words.select(F.explode(tx.ngrams(F.col("_w"), n)).alias("term"))


def top_terms(terms: DataFrame, k: int = fv.TOP_TERMS) -> DataFrame:
    """The ``k`` most frequent terms, ties by term (distributed top-k)."""
    return terms.groupBy("term").count().orderBy(F.desc("count"), F.asc("term")).limit(k)


def top_ngrams(df: DataFrame, col: str, n: int, k: int = fv.TOP_TERMS) -> DataFrame:
    return top_terms(ngram_rows(df, col, n), k)


def symbol_inventory(df: DataFrame, col: str) -> DataFrame:
    """Distinct maximal runs of non-word characters with their frequency."""
    return (df.select(F.explode(tx.symbol_runs(F.coalesce(F.col(col), F.lit("")))).alias("symbol"))
            .groupBy("symbol").count())
