"""Profiling and publication statistics (all aggregates, nothing collected)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentsift.functions import fixed_values as fv
from sentsift.functions import text as tx
from sentsift.operators.clean import stored


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First ``n`` rows in key order."""
    return df.orderBy(key).limit(n)


def _unpivot(agg_row: DataFrame, cols: list[str], value: str) -> DataFrame:
    return agg_row.unpivot([], cols, "column", value)


def null_counts(df: DataFrame) -> DataFrame:
    """``(column, null_count)`` — one pass over the table."""
    cols = df.columns
    row = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    return _unpivot(row, cols, "null_count")


def nonnull_counts(df: DataFrame) -> DataFrame:
    """``(column, non_null)``."""
    cols = df.columns
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    return _unpivot(row, cols, "non_null")


def schema_profile(df: DataFrame) -> DataFrame:
    """``(position, column, type, non_null)`` — names, declared types, counts."""
    types = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "position int, column string, type string")
    return F.broadcast(types).join(nonnull_counts(df), "column").select(
        "position", "column", "type", "non_null")


def _digests(subset: list[str]) -> list[Column]:
    """128 bits of the values (NULLs equal) in place of the values, which may be whole texts."""
    return [F.xxhash64(*[F.coalesce(F.md5(F.col(c).cast("string")), F.lit("")) for c in subset]).alias("_x"),
            F.md5(F.concat_ws(",", *[F.coalesce(F.md5(F.col(c).cast("string")), F.lit("")) for c in subset])).alias("_m")]


def duplicate_counts(df: DataFrame, subset: list[str]) -> DataFrame:
    """``(is_duplicate, count)``: rows repeating an earlier row on ``subset``.

    NULLs compare equal, as in pandas. Counts only — no row order needed.
    """
    g = df.groupBy(*_digests(subset)).count()
    row = g.agg(F.sum(F.col("count") - 1).alias("dup"), F.count(F.lit(1)).alias("first"))
    return row.select(F.explode(F.array(
        F.struct(F.lit(True).alias("is_duplicate"), F.col("dup").alias("count")),
        F.struct(F.lit(False).alias("is_duplicate"), F.col("first").alias("count")))).alias("x")
    ).select("x.is_duplicate", "x.count").where(F.col("count") > 0)


def duplicate_flags(df: DataFrame, subset: list[str], order: str) -> DataFrame:
    """Row-level flag: True when an earlier row (by ``order``) has the same ``subset``."""
    marked = df.select("*", *_digests(subset))
    first = marked.groupBy("_x", "_m").agg(F.min(order).alias("_first"))
    return marked.join(first, ["_x", "_m"]).select(*df.columns, (F.col(order) != F.col("_first")).alias("is_duplicate"))


def distinct_in_order(df: DataFrame, col: str, order: str) -> DataFrame:
    """Distinct values with the position of their first appearance."""
    return df.groupBy(col).agg(F.min(order).alias("first_seen")).orderBy("first_seen")


def value_counts(df: DataFrame, col: str, top: int | None = fv.TOP_PUBLICATIONS) -> DataFrame:
    """``(value, count)`` descending, ties by value; ``top`` rows (a top-k report)."""
    out = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).count()
           .orderBy(F.desc("count"), F.asc("value")))
    return out.limit(top) if top else out


def publications_by(df: DataFrame, col: str, top: int | None = fv.TOP_PUBLICATIONS,
                    granularity: str | None = None, split: str | None = None) -> DataFrame:
    """Articles per date / author / journal.

    ``granularity`` ('month', 'year', ...) truncates a date column first;
    ``split`` counts each element of a separated list (e.g. ``';'`` for authors).
    """
    c = F.col(col)
    if granularity:
        c = F.date_format(F.date_trunc(granularity, F.to_date(c)), "yyyy-MM-dd")
    if split:
        parts = df.select(F.explode(F.split(c, split)).alias(col))
        return value_counts(parts.select(F.trim(col).alias(col)), col, top)
    return value_counts(df.select(c.alias(col)), col, top)


def date_extremes(df: DataFrame, col: str) -> DataFrame:
    """Most and fewest articles on one value, with the (earliest) value at the extremes."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).count()
    return counts.agg(
        F.max("count").alias("max_count"),
        F.min_by(col, F.struct(-F.col("count"), F.col(col))).alias("max_value"),
        F.min("count").alias("min_count"),
        F.min_by(col, F.struct(F.col("count"), F.col(col))).alias("min_value"),
        F.count(F.lit(1)).alias("distinct_values"))


def _log_likelihood(k: Column, n: Column, x: Column) -> Column:
    least = F.lit(1e-10)
    return F.log(F.greatest(x, least)) * k + F.log(F.greatest(1 - x, least)) * (n - k)


def collocation_score(k: Column, a: Column, b: Column, n: Column) -> Column:
    """Dunning's likelihood ratio of a pair met k times, of words met a and b times among n words."""
    rest = (b - k) / (n - a)
    return -2 * (_log_likelihood(k, a, b / n) + _log_likelihood(b - k, n - a, b / n)
                 - _log_likelihood(k, a, k / a) - _log_likelihood(b - k, n - a, rest))


def wordcloud_weights(df: DataFrame, col: str, stopwords=None, max_words: int = fv.WORDCLOUD_MAX_WORDS,
                      threshold: float = fv.COLLOCATION_THRESHOLD) -> DataFrame:
    """Word and word pair weights over distinct texts: ``(word, count, weight)``, top ``max_words``.

    Words are ``\\w[\\w']*`` runs, lower-cased, numbers dropped. A plural in ``s`` counts for its singular where that
    occurs too. Neighbouring words, neither of them a stop word, whose likelihood ratio exceeds ``threshold`` become an
    entry of their own, and their occurrences leave the counts of the two words. ``weight = count / max(count)``. Equal
    texts are told by two digests, so no whole text is a shuffle key. The words of the texts, the counts and the pairs,
    each read more than once, are stored in the shared folder.
    """
    stops = list(fv.WORDCLOUD_STOPWORDS if stopwords is None else stopwords)
    c = F.col(col)
    bare = lambda x: F.when(x.endswith("'s"), F.substring(x, 1, F.length(x) - 2)).otherwise(x)
    # A number begins below ":", so other words need no pattern.
    found = F.filter(F.transform(F.regexp_extract_all("t", F.lit(fv.WORDCLOUD_TOKEN), 0), lambda x: F.lower(bare(x))),
                     lambda x: (x != "") & ~((x < ":") & x.rlike("^[0-9]+$")))
    texts = df.where(c.isNotNull()).groupBy(F.md5(c).alias("_m"), F.xxhash64(c).alias("_x")).agg(F.first(c).alias("t"))
    once = stored(texts.select(found.alias("l")), "words")
    word = once.select(F.explode("l").alias("word")).where(~F.col("word").isin(*stops)).groupBy("word").agg(F.count("*").alias("c"))
    singular = word.select(F.col("word").alias("_s"))
    stem = F.when(F.col("word").endswith("s") & ~F.col("word").endswith("ss"), F.expr("left(word, length(word) - 1)"))
    std = stored(word.join(singular, stem == F.col("_s"), "left").select("word", "c", F.coalesce("_s", "word").alias("form")), "forms")
    uni = std.groupBy("form").agg(F.sum("c").alias("c"))
    size = F.size("l")
    ahead = F.slice("l", 2, F.greatest(size, F.lit(1)))
    # The last word has no partner and drops out.
    pairs = (once.select(F.explode(F.arrays_zip(F.col("l").alias("w1"), ahead.alias("w2"))).alias("x")).select("x.w1", "x.w2")
             .where(F.col("w2").isNotNull() & ~F.col("w1").isin(*stops) & ~F.col("w2").isin(*stops))
             .groupBy("w1", "w2").agg(F.count("*").alias("k")))
    # One table leads from a word to its form and the form's count, so pairs are dealt by word only, not by form again.
    held = stored(std.join(uni.withColumnRenamed("c", "f"), "form").select("word", "form", "f"), "counts")
    as_first = held.select(F.col("word").alias("w1"), F.col("form").alias("f1"), F.col("f").alias("a"))
    as_second = held.select(F.col("word").alias("w2"), F.col("form").alias("f2"), F.col("f").alias("b"))
    forms = (pairs.join(as_first, "w1").join(as_second, "w2").groupBy("f1", "f2")
             .agg(F.sum("k").alias("k"), F.max("a").alias("a"), F.max("b").alias("b")))
    total = uni.agg(F.sum("c").cast("double").alias("n")).first()["n"] or 0.0
    n, k, a, b = F.lit(total), F.col("k").cast("double"), F.col("a").cast("double"), F.col("b").cast("double")
    col_ = stored(forms.where((n > a) & (n > b)).where(collocation_score(k, a, b, n) > threshold).select("f1", "f2", "k"), "pairs")
    used = (col_.select(F.col("f1").alias("form"), "k").unionByName(col_.select(F.col("f2").alias("form"), "k"))
            .groupBy("form").agg(F.sum("k").alias("k")))
    counts = (uni.join(used, "form", "left").select(F.col("form").alias("word"), (F.col("c") - F.coalesce("k", F.lit(0))).alias("count"))
              .unionByName(col_.select(F.concat_ws(" ", "f1", "f2").alias("word"), F.col("k").alias("count"))).where("count > 0"))
    top = counts.orderBy(F.desc("count"), F.asc("word")).limit(max_words)
    # max(count) is the first row of the top list; a window over <= max_words rows.
    from pyspark.sql import Window as W
    return top.withColumn("weight", F.col("count") / F.max("count").over(W.partitionBy()))


def before_after(df: DataFrame, key: str, raw: str, cleaned: str) -> DataFrame:
    """Raw against cleaned text per row as length statistics."""
    return df.select(
        key, F.length(raw).cast("long").alias("raw_chars"), F.length(cleaned).cast("long").alias("clean_chars"),
        F.size(tx.split_ws(F.coalesce(F.col(raw), F.lit("")))).cast("long").alias("raw_words"),
        F.size(tx.split_ws(F.coalesce(F.col(cleaned), F.lit("")))).cast("long").alias("clean_words"))


def embedding_shape(df: DataFrame, col: str) -> DataFrame:
    """Number of vectors and their dimension range."""
    return df.agg(F.count(F.lit(1)).alias("n_vectors"), F.min(F.size(col)).cast("long").alias("min_dim"),
                  F.max(F.size(col)).cast("long").alias("max_dim"))
