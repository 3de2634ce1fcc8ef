"""Sentences, tokens and questions (one row per sentence / question)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentsift.functions import text as tx


def sentence_table(articles: DataFrame, key: str = "doc_id", text: str = "body_text") -> DataFrame:
    """``(key, n_sent, pos, sentence)``: one row per sentence, ``pos`` 0-based in
    the article, ``n_sent`` the article's sentence count (carried per row so no
    aggregation is needed to get it)."""
    return (articles.select(key, tx.split_sentences(F.col(text)).alias("_s"))
            .select(key, F.size("_s").alias("n_sent"), F.posexplode("_s").alias("pos", "sentence")))


def with_tokens(df: DataFrame, col: str = "sentence", out: str = "tokens") -> DataFrame:
    """Adds the filtered word tokens of the normalised sentence."""
    return df.withColumn(out, tx.sentence_tokens(F.col(col)))


def sentence_frame(articles: DataFrame, key: str = "doc_id", text: str = "body_text") -> DataFrame:
    """Long form of the reference's sentence frame: ``(key, pos, sentence, tokens)``."""
    return with_tokens(sentence_table(articles, key, text))


def sentence_frame_nested(articles: DataFrame, key: str = "doc_id", text: str = "body_text") -> DataFrame:
    """Nested form: per article the sentence list and the token list per sentence."""
    s = tx.split_sentences(F.col(text))
    return articles.select(
        "*", s.alias("sentences"),
    ).withColumn("token_sentences", F.transform("sentences", lambda x: tx.sentence_tokens(x)))


def question_frame(questions: DataFrame, raw: bool = False) -> DataFrame:
    """``(q_id, question, tokens)``.

    By default questions are normalised and tokenised like sentences;
    ``raw=True`` keeps the reference's plain word split of the unnormalised
    question (case and punctuation kept).
    """
    if raw:
        toks = tx.split_ws(F.regexp_replace(F.col("question"), r"([.,!?;:()])", " $1 "))
    else:
        toks = tx.sentence_tokens(F.col("question"))
    return questions.withColumn("tokens", toks)


def question_explode(questions: DataFrame, start: int, end: int) -> DataFrame:
    """Questions with ``start <= q_id < end`` (half-open, see README)."""
    return questions.where((F.col("q_id") >= start) & (F.col("q_id") < end))


def question_prefix(questions: DataFrame, generic: str = "What is covid-19?") -> DataFrame:
    """Puts a generic question before each question (off unless called).

    Question ``i`` becomes ids ``2i`` (generic) and ``2i+1`` (original).
    """
    both = F.array(F.struct(F.lit(0).alias("k"), F.lit(generic).alias("q")),
                   F.struct(F.lit(1).alias("k"), F.col("question").alias("q")))
    return (questions.select("q_id", F.explode(both).alias("x"))
            .select((F.col("q_id") * 2 + F.col("x.k")).alias("q_id"), F.col("x.q").alias("question")))


def join_questions(questions: DataFrame) -> DataFrame:
    """All questions glued into one string, in ``q_id`` order (one row)."""
    return questions.agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("q_id", "question"))), lambda x: x["question"]), " "
    ).alias("joined_question"))


def document_tokens(df: DataFrame, key: str, col: str) -> DataFrame:
    """Whitespace word tokens of the lower-cased whole document."""
    return df.select(key, tx.split_ws(F.lower(F.coalesce(F.col(col), F.lit("")))).alias("tokens"))


def sentence_ids(sentences: DataFrame, questions: DataFrame) -> DataFrame:
    """Sentence text -> id over article sentences then questions; equal texts
    share the id of their last occurrence.

    The id is the position key ``(part, a, b)`` of that last occurrence
    (``part`` 0 = article sentence ``(doc_id, pos)``, 1 = question ``(q_id, 0)``)
    instead of a running number, so no global numbering pass is needed.
    """
    art = sentences.select(F.lit(0).alias("part"), F.col("doc_id").alias("a"), F.col("pos").alias("b"),
                           F.col("sentence").alias("text"))
    qs = questions.select(F.lit(1).alias("part"), F.col("q_id").alias("a"), F.lit(0).alias("b"),
                          F.col("question").alias("text"))
    # Two digests stand for a text, so only the result moves texts, once.
    allrows = art.unionByName(qs).withColumns({"_m": F.md5("text"), "_x": F.xxhash64("text")})
    last = allrows.groupBy("_m", "_x").agg(F.max(F.struct("part", "a", "b")).alias("id"))
    return allrows.join(last, ["_m", "_x"]).select(
        "part", "a", "b", "text", F.col("id.part").alias("id_part"), F.col("id.a").alias("id_a"),
        F.col("id.b").alias("id_b"))
