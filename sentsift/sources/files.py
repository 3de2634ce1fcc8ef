"""Metadata CSV, article JSON, body assembly, Parquet hand-over between stages."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# FIXED VALUES — strings that pandas' CSV reader turns into missing values and
# that the metadata reader therefore normalises to NULL (after trimming).
NULL_LITERALS = ["", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "#N/A", "n/a",
                 "<NA>", "-NaN", "-nan", "1.#IND", "1.#QNAN", "#N/A N/A", "#NA",
                 "-1.#IND", "-1.#QNAN"]

METADATA_COLUMNS = ["cord_uid", "sha", "source_x", "title", "doi", "pmcid", "pubmed_id",
                    "license", "abstract", "publish_time", "authors", "journal", "mag_id",
                    "who_covidence_id", "arxiv_id", "pdf_json_files", "pmc_json_files",
                    "url", "s2_id"]
# Identifier / licence columns the corpus build does not carry.
DROPPED_METADATA = ["sha", "source_x", "doi", "pmcid", "pubmed_id", "license", "mag_id",
                    "who_covidence_id", "arxiv_id", "s2_id"]

#: Name of the file that marks a stored table as whole; Spark's readers pass over it.
MANIFEST = "_sentsift_manifest"

ARTICLE_JSON_SCHEMA = T.StructType([
    T.StructField("paper_id", T.StringType()),
    T.StructField("body_text", T.ArrayType(T.StructType([
        T.StructField("section", T.StringType()),
        T.StructField("text", T.StringType()),
    ]))),
])


def null_normalise(c: Column) -> Column:
    return F.when(F.trim(c).isin(*NULL_LITERALS) | c.isNull(), F.lit(None).cast("string")).otherwise(c)


#: Text fields keep their quotes, line ends and outer spaces.
CSV = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_metadata(spark: SparkSession, path: str, columns: list[str] | None = None, rescued: str | None = None) -> DataFrame:
    """Metadata CSV with a header; every column a string, pandas-style NULLs.

    The schema is declared (no inference pass over the data). Quoted fields may
    hold newlines and doubled quotes. ``rescued`` names a column for records
    that do not fit the header; they are kept, with that column set.
    """
    if columns is None:
        header = spark.read.option("header", True).csv(path).columns
        columns = header
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, *([rescued] if rescued else [])]])
    reader = spark.read.schema(schema).options(**CSV).option("multiLine", True)
    if rescued:
        reader = reader.option("columnNameOfCorruptRecord", rescued)
    return reader.csv(path).select(*[null_normalise(F.col(c)).alias(c) for c in columns], *([rescued] if rescued else []))


def missing_bodies(metadata: DataFrame, bodies: DataFrame) -> DataFrame:
    """Articles whose first JSON path has no body among ``bodies`` (json_path, ...)."""
    first = F.trim(F.split(F.col("pdf_json_files"), ";")[0])
    return metadata.withColumn("json_path", first).join(bodies.select("json_path"), "json_path", "left_anti")


def read_article_json(spark: SparkSession, root: str, lines: bool = False) -> DataFrame:
    """All article JSON files under ``root`` as ``(json_path, body_text array)``.

    ``json_path`` is relative to ``root`` so it equi-joins with the
    ``pdf_json_files`` column of the metadata. With ``lines`` a file holds many
    articles, one a line, each with its own ``json_path``: a file an article
    costs its creation, listing and opening however short the article is.
    """
    if lines:
        schema = T.StructType([T.StructField("json_path", T.StringType()), *ARTICLE_JSON_SCHEMA.fields])
        return spark.read.schema(schema).option("recursiveFileLookup", True).json(root).select("json_path", "body_text")
    df = (spark.read.schema(ARTICLE_JSON_SCHEMA).option("multiLine", True)
          .option("recursiveFileLookup", True).json(root)
          .select("body_text", F.col("_metadata.file_path").alias("file_path")))
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(root)
    place = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place)
    # Both sides as the file system names them: without scheme and authority, percent-decoded.
    prefix = place.toUri().getPath().rstrip("/") + "/"
    path = F.url_decode(F.regexp_replace(F.regexp_replace("file_path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), "\\+", "%2B"))
    return df.select(F.when(path.startswith(prefix), F.substr(path, F.lit(len(prefix) + 1))).otherwise(path)
                     .alias("json_path"), "body_text")


def assemble_body(parts: DataFrame, key: str, pos: str, section: str, text: str) -> DataFrame:
    """One body string per key from ordered ``(section, text)`` parts.

    Texts of one section are concatenated in order with no separator; sections
    appear in first-seen order, each emitted as ``section\\n\\ntext\\n\\n``.
    Two aggregations: per (key, section), then per key.
    """
    per_section = parts.groupBy(key, section).agg(
        F.min(pos).alias("_first"),
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"),
                                                 F.coalesce(F.col(text), F.lit("")).alias("t")))),
            lambda x: x["t"]), "").alias("_txt"),
    )
    return per_section.groupBy(key).agg(
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct(F.col("_first").alias("p"),
                                                 F.coalesce(F.col(section), F.lit("")).alias("s"),
                                                 F.col("_txt").alias("t")))),
            lambda x: F.concat(x["s"], F.lit("\n\n"), x["t"], F.lit("\n\n"))), "").alias("body_text"))


def assemble_body_from_json(bodies: DataFrame, key: str = "json_path") -> DataFrame:
    """``assemble_body`` over the nested ``body_text`` array of article JSON."""
    parts = bodies.select(key, F.posexplode("body_text").alias("pos", "part")).select(
        key, "pos", F.col("part.section").alias("section"), F.col("part.text").alias("text"))
    return assemble_body(parts, key, "pos", "section", "text")


def build_corpus(metadata: DataFrame, json_bodies: DataFrame, n: int, seed: str = "0") -> DataFrame:
    """Corpus build from metadata and article JSON (``read_article_json``)."""
    return build_corpus_from(metadata, assemble_body_from_json(json_bodies), n, seed)


def build_corpus_from(metadata: DataFrame, bodies: DataFrame, n: int, seed: str = "0") -> DataFrame:
    """Drop id columns, keep rows with a JSON path, exact seeded sample of
    ``n``, drop rows with any NULL, first JSON path, attach the body by an
    equi-join on the path (``bodies``: ``json_path, body_text``)."""
    from sentsift.operators.prepare import sample_n

    m = metadata.drop(*[c for c in DROPPED_METADATA if c in metadata.columns])
    m = m.na.drop(subset=["pdf_json_files"])
    m = sample_n(m, n, "cord_uid", seed).na.drop("any")
    m = m.withColumn("pdf_json_files", F.trim(F.split(F.col("pdf_json_files"), ";")[0]))
    return m.join(bodies, m.pdf_json_files == bodies.json_path, "inner").drop("json_path")


def read_word_vectors(spark: SparkSession, path: str, token: str = "token", vec: str = "vec") -> DataFrame:
    """Token -> vector lookup stored as Parquet: ``(token, vec array<double>)``.

    Pretrained vectors are converted once to this table; vectors are cast to
    double before any arithmetic.
    """
    df = spark.read.parquet(path)
    return df.select(F.col(token).alias("token"), F.transform(vec, lambda x: x.cast("double")).alias("vec"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.options(**CSV).csv(path)
    else:
        w.parquet(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return spark.read.options(**CSV).option("multiLine", True).csv(path)
    return spark.read.parquet(path)


def reuse_or_build(spark: SparkSession, path: str, build, identity: str = "") -> DataFrame:
    """Read a materialised table if present, else build it, commit it, read it back.

    The table is written beside its place, gets a manifest with ``identity`` (of the input and the parameters) and is
    renamed, so a reader meets a whole table or none; of two writers the first one's table stays. A folder without a
    manifest, or with another identity, is reported and never overwritten. The written table also cuts lineage.
    """
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(place):
        own = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
        build().write.parquet(own.toString())
        out = fs.create(jvm.org.apache.hadoop.fs.Path(own, MANIFEST))
        out.write(bytearray(identity.encode()))
        out.close()
        # Some stores rename into an existing folder instead of failing: such a table has lost the race.
        if not fs.exists(place) and not fs.rename(own, place) and not fs.exists(place):
            raise OSError(f"{path} could not be committed")
        fs.delete(own, True)
        fs.delete(jvm.org.apache.hadoop.fs.Path(place, own.getName()), True)
    manifest = jvm.org.apache.hadoop.fs.Path(place, MANIFEST)
    if not fs.exists(manifest):
        raise ValueError(f"{path} exists without a manifest: not a whole table; remove it to build it anew")
    stream = fs.open(manifest)
    held = bytes(stream.readAllBytes()).decode()
    stream.close()
    if held != identity:
        raise ValueError(f"{path} was built from other input or parameters ({held!r}, not {identity!r})")
    return spark.read.parquet(path)
