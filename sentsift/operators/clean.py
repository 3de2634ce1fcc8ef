"""Text cleaning over whole texts: column expressions plus a lemma join."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentsift.functions import fixed_values as fv
from sentsift.functions import text as tx
from sentsift.operators.vectors import batch_tokens
from sentsift.session import ensure_checkpoint_dir, ship_package


def lemma_table(words: DataFrame, vocabulary: DataFrame | None, exceptions: dict[str, str] | None = None) -> DataFrame:
    """``(word, lemma)`` for every distinct word whose noun lemma differs.

    ``vocabulary`` (word) holds the known nouns (none: only exceptions apply), ``exceptions`` the irregular plurals (``fixed_values.NOUN_EXCEPTIONS``
    unless given), which win. Other candidates are the word itself and the WordNet-style suffix rules
    (``fixed_values.NOUN_SUFFIX_RULES``); they count only if the vocabulary holds them, which one semi-join decides, and
    the shortest wins (the word itself, then the earliest rule, on a tie). The lemma of a word depends on nothing else.
    """
    exceptions = fv.NOUN_EXCEPTIONS if exceptions is None else exceptions
    distinct = words.select("word").where(F.col("word") != "").distinct()
    vocab = (distinct.limit(0) if vocabulary is None else vocabulary).select(F.col("word").alias("cand")).distinct()
    rules = F.array(*[F.struct(F.lit(i).alias("r"), F.lit(suf).alias("suf"), F.lit(rep).alias("rep"))
                      for i, (suf, rep) in enumerate([("", ""), *fv.NOUN_SUFFIX_RULES], start=-1)])
    cands = (distinct.select("word", F.explode(rules).alias("x"))
             .where(F.col("word").endswith(F.col("x.suf")))
             .select("word", F.col("x.r").alias("r"),
                     F.concat(F.expr("substring(word, 1, length(word) - length(x.suf))"), F.col("x.rep"))
                     .alias("cand")))
    known = F.create_map(*[F.lit(x) for kv in exceptions.items() for x in kv]) if exceptions else None
    irregular = F.try_element_at(known, F.col("word")) if exceptions else F.lit(None).cast("string")
    best = (cands.join(vocab, "cand", "left_semi").groupBy("word")
            .agg(F.min_by("cand", F.struct(F.length("cand"), F.col("r"))).alias("best")))
    return (distinct.join(best, "word", "left").select("word", F.coalesce(irregular, "best").alias("lemma"))
            .where(F.col("lemma") != F.col("word")))


def apply_lemmas(df: DataFrame, key: str, cols: dict[str, str], lemmas: DataFrame) -> DataFrame:
    """Replace the words of each ``cols`` column (input -> output name) by their lemma; ``key`` is unique.

    The distinct words of a row that have a lemma come back to it as one small map, so words travel once per row and
    text, not once per occurrence, and a frequent word is no hot group. The words of a batch are looked up at once.
    """
    ship_package(df.sparkSession)
    pieces = {src: tx.split_ws(F.coalesce(F.col(src), F.lit(""))) for src in cols}
    words = df.select(key, F.explode(F.array_distinct(F.concat(*pieces.values()))).alias("word"))
    maps = (words.join(lemmas, "word").groupBy(key)
            .agg(F.map_from_entries(F.collect_list(F.struct("word", "lemma"))).alias("_lemmas")))
    others = [c for c in df.columns if c != key and c not in cols]
    joined = df.join(maps, key, "left").select(key, *cols, "_lemmas", *others)
    types = T.StructType([df.schema[key], *(T.StructField(dst, T.StringType()) for dst in cols.values()), *(df.schema[c] for c in others)])
    return joined.mapInArrow(_replaced(len(cols)), types)


def _replaced(n: int):
    """Rows (key, n texts, their lemmas, other columns) with the words of the texts replaced, one space apart."""
    def run(batches):
        for batch in batches:
            lemmas = [dict(x) if x else None for x in batch.column(n + 1).to_pylist()]
            texts = [pa.array([" ".join(words if known is None else [known.get(w, w) for w in words])
                               for words, known in zip(((t or "").split() for t in column.to_pylist()), lemmas, strict=True)], pa.string())
                     for column in batch.columns[1: n + 1]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *texts, *batch.columns[n + 2:]],
                                             names=[str(k) for k in range(batch.num_columns - 1)])
    return run


def lemmatize(df: DataFrame, key: str, col: str, out: str, vocabulary: DataFrame | None = None,
              lemmas: DataFrame | None = None) -> DataFrame:
    """``df`` with ``out``: each whitespace word of ``col`` replaced by its lemma, order kept."""
    if lemmas is None:
        words = df.select(F.explode(tx.split_ws(F.coalesce(F.col(col), F.lit("")))).alias("word"))
        lemmas = lemma_table(words, vocabulary)
    return apply_lemmas(df.withColumn("_text", F.col(col)), key, {"_text": out}, lemmas)


def stored(df: DataFrame, name: str = "cleaned", passing: list[str] | None = None) -> DataFrame:
    """The rows written to the shared folder and read back (``checkpoint`` would work them out twice).

    ``passing`` gets the folder's path, for ``discard``.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if passing is not None:
        passing.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, passing: list[str]) -> None:
    """Delete stored rows that nothing reads any more."""
    jvm = spark._jvm
    for path in passing:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def preprocess_corpus(articles: DataFrame, vocabulary: DataFrame | None = None, key: str = "doc_id", lemma: bool = True,
                      contractions_first: bool = False, passing: list[str] | None = None) -> DataFrame:
    """Adds ``preprocessed_abstract`` and ``preprocessed_body_text``; ``vocabulary`` (word): the nouns of ``lemma_table``.

    ``passing``: see ``stored``; to be discarded when the result has been written.
    """
    df = articles.select(
        key,
        tx.clean_text_no_lemma("abstract", contractions_first).alias("_a"),
        tx.clean_text_no_lemma("body_text", contractions_first).alias("_b"))
    if not lemma:
        return df.select(key, F.col("_a").alias("preprocessed_abstract"), F.col("_b").alias("preprocessed_body_text"))
    df = stored(df, passing=passing)  # cleaned once, read for the words, their lemmas and the result
    words = batch_tokens(df.select(F.concat(F.split("_a", " "), F.split("_b", " ")).alias("tokens")))
    # As a table the lemmas have a known size: few of them meet the articles where these lie.
    lemmas = stored(lemma_table(words.withColumnRenamed("token", "word"), vocabulary), "lemmas", passing)
    return apply_lemmas(df, key, {"_a": "preprocessed_abstract", "_b": "preprocessed_body_text"}, lemmas)
