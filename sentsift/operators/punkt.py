"""Sentence boundaries learned from the corpus itself (after Kiss and Strunk): abbreviations and sentence starters.

Counts of every token type with and without a final period come from one distributed pass over the texts. A type is an
abbreviation where its periods are far more than chance, weighed down by its length and by occurrences without one; a
word is a sentence starter where it follows sentence ends far more often than chance. Both models are tables, joined to the
places where a sentence might end; a sentence that ends in an abbreviation goes on unless a starter follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentsift.functions import text as tx
from sentsift.operators.profile import collocation_score

ABBREVIATION, STARTER = 0.3, 30.0  # least scores
EDGES = r"^[(\[\"'“‘*]+|[)\]\"'”’,;:*]+$"  # signs around a token that do not belong to its type


def token_type(token: Column) -> Column:
    """Lower-case token without the signs around it; numbers are one type."""
    bare = F.lower(F.regexp_replace(token, EDGES, ""))
    return F.when(bare.rlike(r"^[0-9.,]*[0-9][0-9.,]*$"), F.concat(F.lit("##"), F.when(bare.endswith("."), ".").otherwise("")))\
        .otherwise(bare)


def type_counts(texts: DataFrame, col: str) -> DataFrame:
    """``(type, with_period, without)``: occurrences of every type, by whether a period follows it."""
    # Equal tokens are counted first, so that the type of each is worked out once.
    tokens = (texts.select(F.explode(tx.split_ws(F.coalesce(F.col(col), F.lit("")))).alias("t")).groupBy("t")
              .agg(F.count(F.lit(1)).alias("c")).select(token_type(F.col("t")).alias("t"), "c"))
    ends = F.col("t").endswith(".")
    return (tokens.where("t <> '' and t <> '.'")
            .groupBy(F.when(ends, F.expr("left(t, length(t) - 1)")).otherwise(F.col("t")).alias("type"))
            .agg(F.sum(F.when(ends, F.col("c")).otherwise(0)).alias("with_period"),
                 F.sum(F.when(~ends, F.col("c")).otherwise(0)).alias("without")))


def abbreviations(counts: DataFrame, least: float = ABBREVIATION) -> DataFrame:
    """``(type, with_period, without, score)`` of the types that are abbreviations; ``counts``: ``type_counts``."""
    total = counts.agg(F.sum(F.col("with_period") + F.col("without")).cast("double").alias("n"),
                       F.sum("with_period").cast("double").alias("p")).first()
    n, p = total["n"] or 1.0, total["p"] or 0.0
    if p == 0:
        return counts.select("*", F.lit(0.0).alias("score")).limit(0)
    k, rest = F.col("with_period").cast("double"), F.col("without").cast("double")
    chance, sure = F.lit(min(p / n, 1 - 1e-9)), F.lit(0.99)
    ratio = -2 * (k * F.log(chance) + rest * F.log(1 - chance) - k * F.log(sure) - rest * F.log(1 - sure))
    periods = F.length("type") - F.length(F.replace("type", F.lit("."), F.lit(""))) + 1
    letters = (F.length("type") + 1 - periods).cast("double")
    score = ratio * F.exp(-letters) * periods * F.pow(letters, -rest)
    return (counts.where((F.col("with_period") > 0) & F.col("type").rlike(r"\p{L}"))
            .select("*", F.round(score, 6).alias("score")).where(F.col("score") >= least))


def sentence_starters(sentences: DataFrame, counts: DataFrame, known: DataFrame, least: float = STARTER) -> DataFrame:
    """``(type, score)``: words that follow sentence ends far more often than chance.

    ``sentences``: rows ``(ends, next)`` of ``boundaries``; ends in an abbreviation do not count.
    """
    real = sentences.join(known.select(F.col("type").alias("ends")), "ends", "left_anti")
    total = counts.agg(F.sum(F.col("with_period") + F.col("without")).cast("double")).first()[0] or 1.0
    breaks = float(real.count())
    if breaks == 0:
        return counts.select("type", F.lit(0.0).alias("score")).limit(0)
    after = real.groupBy(F.col("next").alias("type")).agg(F.count("*").alias("k"))
    seen = counts.select("type", (F.col("with_period") + F.col("without")).cast("double").alias("b"))
    n, a = F.lit(total), F.lit(breaks)
    k = F.col("k").cast("double")
    return (after.join(seen, "type").where(F.col("type").rlike(r"\p{L}") & (k / a > F.col("b") / n) & (n > a) & (F.col("b") >= k))
            .select("type", F.round(collocation_score(k, a, F.col("b"), n), 6).alias("score")).where(F.col("score") >= least))


def pieces(texts: DataFrame, col: str) -> Column:
    """The pieces of a column of texts, or a column that holds pieces already."""
    return F.col(col) if texts.schema[col].dataType.typeName() == "array" else tx.split_sentences(F.col(col))


def boundaries(texts: DataFrame, key: str, col: str) -> DataFrame:
    """``(key, i, ends, next, upper)``: possible sentence ends, with the last type (no period) and the next word's type.

    Ends in ``!`` or ``?`` have a null ``ends``. ``i`` is the number of the piece that would begin a sentence.
    """
    pairs = texts.select(F.col(key), pieces(texts, col).alias("s")).where(F.size("s") > 1).select(key, F.posexplode(F.arrays_zip(
        F.col("s").alias("a"), F.slice("s", 2, F.size("s") - 1).alias("b"))).alias("i", "x")).where("x.b is not null")
    last = F.regexp_extract("x.a", r"(\S+)$", 1)
    first = F.regexp_extract("x.b", r"^(\S+)", 1)
    kind = token_type(last)
    following = token_type(first)
    return pairs.select(key, (F.col("i") + 1).alias("i"),
                        F.when(kind.endswith("."), F.regexp_replace(kind, r"\.$", "")).alias("ends"),
                        F.regexp_replace(following, r"\.$", "").alias("next"), first.rlike(r"^[^\p{L}]*\p{Lu}").alias("upper"))


def split_sentences(texts: DataFrame, key: str, col: str, known: DataFrame, starters: DataFrame,
                    places: DataFrame | None = None) -> DataFrame:
    """``(key, sentences)``: the pieces of ``text.split_sentences`` joined again after abbreviations; ``key`` is unique.

    ``places``: the ``boundaries`` of the texts, where they are made already.
    """
    ends = (boundaries(texts, key, col) if places is None else places).where("ends is not null")
    opens = starters.select(F.col("type").alias("next"), F.lit(True).alias("starter"))
    joined = (ends.join(known.select(F.col("type").alias("ends")), "ends", "left_semi").join(opens, "next", "left")
              .where(~(F.coalesce("starter", F.lit(False)) & F.col("upper"))).groupBy(key).agg(F.collect_set("i").alias("joined")))
    whole = texts.select(F.col(key), pieces(texts, col).alias("s")).join(joined, key, "left")
    n = F.size("s")
    starts = F.array_except(F.sequence(F.lit(0), n - 1), F.coalesce("joined", F.array().cast("array<int>")))
    stops = F.concat(F.slice("starts", 2, F.size("starts")), F.array(n))
    return (whole.withColumn("starts", starts).withColumn("spans", F.arrays_zip(F.col("starts").alias("a"), stops.alias("b")))
            .select(key, F.transform("spans", lambda x: F.array_join(F.slice("s", x["a"] + 1, x["b"] - x["a"]), " ")).alias("sentences")))
