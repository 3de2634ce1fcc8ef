"""Quality by hierarchical empirical Bayes: classifier evidence of a document combined with its host and path.

1. A logistic regression on text shape (JVM expressions over whole texts) gives every document a probability. It is
   fitted on at most ``MAX_LABELS`` labelled rows, a documented bound.
2. Grouped sums of these probabilities give each path its rate. A path's posterior shrinks toward its host's, a host's
   toward the global rate; the prior weights come from the spread between groups (method of moments), so sparse sites
   follow their parent and large ones speak for themselves.
3. The document's logit is moved by its site's log odds against the global ones.

Edge cases: null and empty texts have shape zero and are scored; null hosts or paths form a group of their own; a group of
any size is pre-aggregated; without labels of both kinds every document stays at the global rate 0.5 (kept); repeated
rows count as often as they stand; extra columns are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentsift.llm.common import cut
from sentsift.llm.toxicity import sample_labels

MAX_LABELS = 4000
FEATURES = ("symbols", "pipes", "bangs", "capitals", "digits", "short", "repeats", "size")


def shape(text: Column) -> list[Column]:
    """Shares of a text's words and lines, each from 0 to about 1."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t).cast("double"), F.lit(1.0))
    gone = lambda s: (F.length(t) - F.length(F.replace(t, F.lit(s), F.lit("")))) / n
    count = lambda p: F.length(F.regexp_replace(t, p, "")).cast("double") / n
    lines = F.split(t, "\n")
    words = F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1
    return [F.least(count("[^$%#&*]") * 4, F.lit(1.0)).alias("symbols"), F.least(gone("|") * 8, F.lit(1.0)).alias("pipes"),
            F.least(gone("!!") * 5, F.lit(1.0)).alias("bangs"), count("[^A-Z]").alias("capitals"),
            F.least(count("[^0-9]") * 5, F.lit(1.0)).alias("digits"), F.least(words / n * 4, F.lit(1.0)).alias("short"),
            (1 - F.size(F.array_distinct(lines)) / F.size(lines)).alias("repeats"),
            (F.log1p(n) / 12).alias("size")]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text") -> np.ndarray | None:
    """Weights of the logistic regression, intercept last; None without labels of both kinds."""
    rows = (sample_labels(docs, labels, label_col, id_col, text_col, MAX_LABELS // 2, MAX_LABELS // 2)
            .select("label", "__id", *shape(F.col("text"))).orderBy("__id").collect())
    y = np.array([r.label for r in rows], np.float64)
    if len(y) == 0 or y.min() == y.max():
        return None
    x = np.array([[r[f] for f in FEATURES] + [1.0] for r in rows])
    # Good documents are sampled less than they occur; the sum of weights restores equal odds per class.
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-4] * len(FEATURES) + [1e-8])
    for _ in range(25):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        w += np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge @ w)
    return w


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def _prior_weight(groups: DataFrame, rate: Column, parent: Column, n: Column) -> float:
    """Prior rows by the method of moments: within-group over between-group variance; one number."""
    within = parent * (1 - parent)
    row = groups.agg(F.avg(within).alias("w"), F.avg(F.pow(rate - parent, 2) - within / n).alias("b")).first()
    if row.w is None:
        return 1.0
    return min(max(row.w / max(row.b, 1e-4), 1.0), 1e4)


def site_posteriors(scored: DataFrame, host: str, path: str) -> DataFrame:
    """(host, path, g, site): posterior rate of each path from (host, path, p), shrunk to its host and the global rate."""
    paths = cut(scored.groupBy(F.col(host).alias("__h"), F.col(path).alias("__p"))
                .agg(F.sum("p").alias("s"), F.count("*").cast("double").alias("n")), "op8paths")
    total = paths.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    g = F.lit(total.s / total.n if total.n else 0.5)
    hosts = paths.groupBy(F.col("__h").alias("__hh")).agg(F.sum("s").alias("hs"), F.sum("n").alias("hn"))
    kh = _prior_weight(hosts, F.col("hs") / F.col("hn"), g, F.col("hn"))
    hosts = hosts.select("__hh", ((F.col("hs") + kh * g) / (F.col("hn") + kh)).alias("hp"))
    both = paths.join(hosts, F.col("__h").eqNullSafe(F.col("__hh"))).drop("__hh")
    kp = _prior_weight(both, F.col("s") / F.col("n"), F.col("hp"), F.col("n"))
    return both.select("__h", "__p", g.alias("g"),
                       ((F.col("s") + kp * F.col("hp")) / (F.col("n") + kp)).alias("site"))


def score(docs: DataFrame, weights: np.ndarray | None, host: str, path: str, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, evidence, site, score, keep) for every row of ``docs``."""
    if weights is None:
        return docs.select(F.col(id_col).alias("doc_id"), *(F.lit(0.5).alias(c) for c in ("evidence", "site", "score")),
                           F.lit(True).alias("keep"))
    logit = sum((c * float(w) for c, w in zip(shape(F.col(text_col)), weights, strict=False)), F.lit(float(weights[-1])))
    scored = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(host).cast("string").alias("h"),
                             F.col(path).cast("string").alias("pt"),
                             (1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-30.0)), F.lit(30.0))))).alias("p")), "op8p")
    sites = site_posteriors(scored, "h", "pt")
    moved = _logit(F.col("p")) + _logit(F.col("site")) - _logit(F.col("g"))
    out = scored.join(sites, scored["h"].eqNullSafe(sites["__h"]) & scored["pt"].eqNullSafe(sites["__p"]))
    final = 1 / (1 + F.exp(-moved))
    return out.select("doc_id", F.col("p").alias("evidence"), "site", final.alias("score"), (final >= 0.5).alias("keep"))
