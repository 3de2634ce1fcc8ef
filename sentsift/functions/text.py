"""Column expressions for text cleaning, sentence splitting and tokenising.

All functions take and return ``Column`` objects and use only built-in Spark
functions, so they stay inside whole-stage code generation (higher-order
functions are evaluated per row, still JVM-side).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentsift.functions import fixed_values as fv


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _not_in(w: Column, values) -> Column:
    """Membership test against a word list. ``isin`` over more than ten
    literals is rewritten by the optimizer to a hash-set lookup (``InSet``),
    unlike ``array_contains``, which scans the list for every word."""
    values = list(values)
    return ~w.isin(*values) if values else F.lit(True)


def _once(c, fn) -> Column:
    """``fn(c)`` with ``c`` worked out once: inside a function over arrays Spark works out every mention of ``c`` anew."""
    return F.transform(F.array(_col(c)), fn)[0]


# --------------------------------------------------------------------- cleaning
def replace_math(c) -> Column:
    """``[math] ... math]`` (not crossing a newline) becomes ``MATH EQUATION``.

    The pattern needs the literal ``[math]``; texts without it skip the scan.
    """
    return _once(c, lambda t: F.when(t.contains("[math]"), F.regexp_replace(t, fv.MATH_PATTERN, fv.MATH_TAG)).otherwise(t))


def replace_urls(c) -> Column:
    """Every URL-like dotted run becomes ``URL``, but only in texts holding a link.

    The guard is part of the semantics: ``Fig.2`` or ``0.05`` are replaced only
    when the same text also contains ``http`` or ``www``.
    """
    def tagged(c):
        guard = F.lit(False)
        for t in fv.URL_TRIGGERS:
            guard = guard | c.contains(t)
        return F.when(guard, F.regexp_replace(c, fv.URL_PATTERN, fv.URL_TAG)).otherwise(c)
    return _once(c, tagged)


def clear_punct(c) -> Column:
    """Each symbol character (rule ``SYMBOL_CLASS``) and the literal entry become a space."""
    c = F.regexp_replace(_col(c), fv.SYMBOL_CLASS, " ")
    return F.replace(c, F.lit(fv.LITERAL_SYMBOL_ENTRY), F.lit(" "))


def split_ws(c) -> Column:
    """Python ``str.split()``: split on whitespace runs, no empty pieces."""
    return F.filter(F.split(_col(c), fv.WS_JAVA + "+"), lambda x: x != "")


def expand_contractions(c, mapping: dict[str, str] | None = None) -> Column:
    """Map quote variants to ``'`` then replace exact tokens split on one space.

    Every key holds an apostrophe, so a text without one (after the quote
    mapping) is returned as is without splitting it — same result, no work.
    """
    mapping = fv.CONTRACTIONS if mapping is None else mapping
    c = _col(c)
    for q in fv.QUOTE_VARIANTS:
        c = F.replace(c, F.lit(q), F.lit("'"))
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    expanded = lambda c: F.array_join(
        F.transform(F.split(c, " "), lambda t: F.coalesce(F.try_element_at(m, t), t)), " ")
    if all("'" in k for k in mapping):
        return _once(c, lambda t: F.when(t.contains("'"), expanded(t)).otherwise(t))
    return expanded(c)


def remove_stopwords(c, stopwords=None) -> Column:
    """Split on whitespace, drop listed words (case-sensitive), join with one space."""
    stops = fv.WORDCLOUD_STOPWORDS if stopwords is None else stopwords
    return F.array_join(F.filter(split_ws(c), lambda w: _not_in(w, stops)), " ")


def clean_text_no_lemma(c, contractions_first: bool = False, stopwords=None) -> Column:
    """Math/URL tags, symbols, contractions, stop words, lower case — in that order.

    With the default order every contraction has already lost its apostrophe
    when expansion runs, exactly as in the reference pipeline;
    ``contractions_first=True`` runs the expansion before symbol removal.
    """
    c = replace_urls(replace_math(F.coalesce(_col(c), F.lit(""))))
    stops = fv.WORDCLOUD_STOPWORDS if stopwords is None else stopwords
    if contractions_first:
        c = clear_punct(expand_contractions(c))
    else:
        c = expand_contractions(clear_punct(c))
    # After symbol removal no word holds an apostrophe (it is in the symbol
    # class), so such stop words can never match and are not compared.
    stops = [w for w in stops if "'" not in w]
    return F.lower(remove_stopwords(c, stops))


# -------------------------------------------------------------------- sentences
def strip_citations(c) -> Column:
    c = _col(c)
    for p in fv.CITATION_PATTERNS:
        c = F.regexp_replace(c, p, "")
    return c


def split_sentences(c) -> Column:
    """Sentence list of a text.

    A sentence ends at ``.``, ``!`` or ``?`` followed by whitespace (a regex
    stand-in for a trained Punkt model: abbreviations also end a sentence).
    As in the reference, ends are marked with ``***``, citations ``[n]`` /
    ``(n)`` are deleted, and the text is split on ``***`` — so a literal
    ``***`` in the text also splits. Pieces are trimmed of whitespace.
    """
    marked = F.regexp_replace(F.coalesce(_col(c), F.lit("")),
                              "([.!?])" + fv.WS_CLASS + "+", "$1" + fv.SENTENCE_MARK)
    pieces = F.split(strip_citations(marked), r"\*\*\*")
    chars = F.lit(WS_CHARS)
    return F.transform(pieces, lambda s: F.btrim(s, chars))


# The characters of ``fixed_values.WS_CLASS`` as a plain set (for btrim).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
            + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")


def normalize_sentence(c) -> Column:
    """Lower-case, then every character outside ``.a-z`` becomes a space (a space is one already)."""
    return F.regexp_replace(F.lower(_col(c)), "[^.a-z ]", " ")


def tokenize_sentence(c, stopwords=None) -> Column:
    """Word tokens of a normalised sentence, filtered.

    Runs of two or more dots and the sentence-final dot are split off as
    tokens (treebank style; inner dots as in ``e.g.`` stay). Drops stop words,
    ``.``, ``shown``, ``fig.``, ``figure`` and tokens of length <= 2.
    """
    drop = list(fv.NLTK_STOPWORDS if stopwords is None else stopwords) + fv.CUSTOM_TOKEN_DROP
    t = F.regexp_replace(_col(c), r"\.{2,}", " $0 ")
    t = F.regexp_replace(t, r"([^.])\. *$", "$1 . ")
    toks = F.split(t, " ")  # the empty pieces of several spaces are too short to stay
    return F.filter(
        toks,
        lambda w: (F.length(w) > fv.MIN_TOKEN_LEN_EXCLUSIVE) & _not_in(w, drop),
    )


def sentence_tokens(c) -> Column:
    """Tokens of a raw sentence. After normalisation a token holds only
    ``.a-z`` and must be longer than 2 characters, so stop words outside that
    shape can never match and are left out of the comparison list."""
    import re
    stops = [w for w in fv.NLTK_STOPWORDS
             if len(w) > fv.MIN_TOKEN_LEN_EXCLUSIVE and re.fullmatch(r"[.a-z]+", w)]
    return tokenize_sentence(normalize_sentence(c), stops)


# ------------------------------------------------------------------------ terms
def words_for_ngrams(c, stopwords=None) -> Column:
    """Lower-case, split on whitespace, drop word-cloud stop words."""
    stops = fv.WORDCLOUD_STOPWORDS if stopwords is None else stopwords
    return F.filter(split_ws(F.lower(_col(c))), lambda w: _not_in(w, stops))


def ngrams(words, n: int) -> Column:
    """Adjacent n-word groups joined by a space; empty when fewer than n words.

    Built from ``n`` aligned slices combined with ``zip_with`` — linear in the
    number of words (a per-index ``slice`` inside a lambda would re-evaluate
    the word array for every position).
    """
    w = _col(words)
    if n == 1:
        return w
    m = F.greatest(F.size(w) - (n - 1), F.lit(0))
    out = F.slice(w, 1, m)
    for k in range(1, n):
        out = F.zip_with(out, F.slice(w, k + 1, m), lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def symbol_runs(c) -> Column:
    """Maximal runs of non-word characters (Python ``re.findall(r'\\W+')``)."""
    return F.regexp_extract_all(_col(c), F.lit(fv.NON_WORD_RUN), 0)
