"""Pruning, filtering, sampling and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def drop_null_key(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows where every listed column is present."""
    return df.na.drop(subset=cols)


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def sample_n(df: DataFrame, n: int, key: str, seed: str = "0") -> DataFrame:
    """Exactly ``min(n, rows)`` rows, repeatable for a seed.

    Rows are ordered by ``md5(key || seed)`` (ties by key) and the first ``n``
    kept — a distributed top-n, so no partition holds more than ``n`` rows.
    """
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def first_of_list(c, sep: str = ";") -> Column:
    """Text before the first separator."""
    c = F.col(c) if isinstance(c, str) else c
    return F.split(c, sep, 2)[0]


RANGES = 64


def add_row_index(df: DataFrame, order: list[str], name: str = "index", ranges: int = RANGES) -> DataFrame:
    """0-based position in an explicit order, numbered range by range.

    Rows fall into at most ``ranges`` ranges of the first column, cut at values of a bounded sample; every range is numbered
    by itself and starts where the rows of those before it end. The sample moves the cuts only, never a number. Rows that
    share a value of the first column are numbered together.
    """
    first = order[0]
    sample = df.select(first).where(F.col(first).isNotNull()).distinct().orderBy(F.xxhash64(first), first).limit(16 * ranges).collect()
    values = sorted(r[0] for r in sample)
    cuts = sorted({values[len(values) * k // ranges] for k in range(1, ranges)}) if values else []
    kind = df.schema[first].dataType
    at = F.size(F.filter(F.array(*(F.lit(c).cast(kind) for c in cuts)), lambda c: c <= F.col(first))) if cuts else F.lit(0)
    dealt = df.withColumn("_range", at.cast("int"))
    before, offsets = 0, []
    for r in sorted(dealt.groupBy("_range").count().collect(), key=lambda r: r["_range"]):  # at most ``ranges`` rows
        offsets += [F.lit(r["_range"]), F.lit(before).cast("long")]
        before += r["count"]
    if not offsets:
        return dealt.drop("_range").withColumn(name, F.lit(0).cast("long"))
    own = F.row_number().over(W.partitionBy("_range").orderBy(*order)).cast("long") - 1
    return dealt.withColumn(name, own + F.create_map(*offsets)[F.col("_range")]).drop("_range")


def parse_number(c) -> Column:
    """Numeric value, or NULL for a bad value."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string").try_cast("double")


def score_threshold(df: DataFrame, threshold: float, col: str = "score") -> DataFrame:
    """Strictly greater than the threshold."""
    return df.where(F.col(col) > threshold)
