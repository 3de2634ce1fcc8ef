"""Cleaning pipeline over ``documents``: five stages, each on all that its predecessor kept.

toxicity (rejected documents go), n-gram Jaccard join (one document of each group stays), benchmark decontamination
(contaminated documents go), PII (spans become ``[KIND]``), SentencePiece (ids of every text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentsift.llm import decontaminate, ngram_join, pii, sentencepiece, toxicity
from sentsift.llm.common import cut, drop_cut, read

#: No SQL: a trained classifier, a trained latent space and a Viterbi search are not expressible in SQL.
ORACLE_SQL = None


#: Rows that go to a Python worker at once. Documents are long: Spark's default of 10,000 rows is some 100 MB in every worker
#: and as much beside the JVM's heap.
BATCH_ROWS = 1000
#: The same where each batch is worked off by itself, so that its size changes no sum.
FEW_ROWS = 250


def _batches(spark: SparkSession, rows: int | None) -> None:
    """``rows`` at once from now on, or Spark's default."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.unset(key) if rows is None else spark.conf.set(key, rows)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _batches(spark, FEW_ROWS)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), "toxic")
    return toxicity.score(docs, model, out_col="__toxic").filter("__toxic < 0.5").drop("__toxic")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _batches(spark, None)  # the join adds up equal shingles batch by batch
    kept = ngram_join.keep_one(docs)
    _batches(spark, BATCH_ROWS)
    return kept


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _batches(spark, BATCH_ROWS)
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _batches(spark, FEW_ROWS)
    return sentencepiece.encode(docs).withColumn("n_tokens", F.coalesce(F.size("ids"), F.lit(0)).cast("long"))


STAGES = [("toxicity", drop_toxic), ("ngram_join", drop_near_copies), ("decontamination", drop_benchmark),
          ("pii", redact_pii), ("sentencepiece", encode_text)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; every stage's rows are written to the shared folder and read back.

    A stage's table is deleted when the next one's is written.
    """
    docs, before = read(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, name)
            if before is not None:
                drop_cut(before)
            before = docs
    return docs
