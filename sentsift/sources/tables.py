"""Readers for the driver's Parquet tables and the article view over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SPREAD_FACTOR = 4


def spread(df: DataFrame) -> DataFrame:
    """Round-robin rows over the cluster when a scan yields fewer partitions than cores.

    Text work (sentence split, tokenising) is row-local and CPU heavy; a table
    stored as one large row group would otherwise be processed by one task.
    On a big multi-file table the scan already has enough splits and this is
    a no-op (no shuffle is added).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        # Several partitions per core: row cost varies with text length, so
        # smaller slices balance better than one slice per core.
        return df.repartition(cores * SPREAD_FACTOR)
    return df


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows carry long texts, spread for row-local text work."""
    return spread(table(spark, sf_dir, name))


def articles(spark: SparkSession, sf_dir: str, abstract: bool = True) -> DataFrame:
    """Article metadata + body built from ``documents`` and ``pages``.

    Stand-in for the metadata + JSON-body corpus: ``cord_uid``/``doc_id`` key, ``title`` = language and source,
    ``abstract`` = the whole page of the same number (missing for articles without one), ``body_text`` = the text,
    ``journal`` = source, plus derived ``authors``, ``publish_time`` and ``pdf_json_files``. Without ``abstract`` the
    column is left out, and ``pages`` is not read.
    """
    d = text_table(spark, sf_dir, "documents")
    if abstract:
        pages = table(spark, sf_dir, "pages").select(F.col("page_id"), F.col("html").alias("abstract"))
        d = d.join(pages, d.doc_id == pages.page_id, "left")
    sid = F.col("doc_id").cast("string")
    return d.select(
        sid.alias("cord_uid"),
        "doc_id",
        F.concat_ws(" ", "lang", "source").alias("title"),
        *(["abstract"] if abstract else []),
        F.col("text").alias("body_text"),
        F.col("source").alias("journal"),
        F.concat(F.lit("author "), (F.col("doc_id") % 97).cast("string")).alias("authors"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") % 97).cast("int"))
        .cast("string").alias("publish_time"),
        F.concat(F.lit("a/"), sid, F.lit(".json; b/"), sid, F.lit(".json")).alias("pdf_json_files"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question set ``(q_id, question)``: every row of ``benchmark``."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(b.item_id.alias("q_id"), b.text.alias("question"))
