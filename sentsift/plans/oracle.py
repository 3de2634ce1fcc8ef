"""DuckDB SQL text equal in meaning to the Spark operators (the correctness oracle).

Fragments take a SQL expression and return a SQL expression; they use the same
fixed values and patterns as ``sentsift.functions``.
"""

from __future__ import annotations

from sentsift.functions import fixed_values as fv

HASHED_DIM = 64  # components of a word vector, each a byte of the token's MD5 digests less 127.5


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


NLTK_STOPS = str_list(fv.NLTK_STOPWORDS)
WC_STOPS = str_list(fv.WORDCLOUD_STOPWORDS)
CUSTOM = str_list(fv.CUSTOM_TOKEN_DROP)
WS = fv.WS_CLASS


def split_ws(e: str) -> str:
    return f"list_filter(string_split_regex({e}, {lit(WS + '+')}), lambda x: x <> '')"


def split_sentences(e: str) -> str:
    marked = f"regexp_replace(coalesce({e}, ''), {lit('([.!?])' + WS + '+')}, '\\1***', 'g')"
    for p in fv.CITATION_PATTERNS:
        marked = f"regexp_replace({marked}, {lit(p)}, '', 'g')"
    return (f"list_transform(string_split_regex({marked}, '\\*\\*\\*'), "
            f"lambda s: regexp_replace(s, {lit('^' + WS + '+|' + WS + '+$')}, '', 'g'))")


def normalize_sentence(e: str) -> str:
    return f"regexp_replace(lower({e}), '[^.a-z]', ' ', 'g')"


def tokenize_sentence(e: str) -> str:
    t = f"regexp_replace({e}, '\\.{{2,}}', ' \\0 ', 'g')"
    t = f"regexp_replace({t}, '([^.])\\. *$', '\\1 . ')"
    return (f"list_filter(string_split_regex({t}, ' +'), lambda w: length(w) > {fv.MIN_TOKEN_LEN_EXCLUSIVE} "
            f"AND NOT list_contains({NLTK_STOPS}, w) AND NOT list_contains({CUSTOM}, w))")


def sentence_tokens(e: str) -> str:
    return tokenize_sentence(normalize_sentence(e))


def replace_math(e: str) -> str:
    return f"regexp_replace({e}, {lit(fv.MATH_PATTERN)}, {lit(fv.MATH_TAG)}, 'g')"


def replace_urls(e: str) -> str:
    guard = " OR ".join(f"contains({e}, {lit(t)})" for t in fv.URL_TRIGGERS)
    return f"(CASE WHEN {guard} THEN regexp_replace({e}, {lit(fv.URL_PATTERN)}, {lit(fv.URL_TAG)}, 'g') ELSE {e} END)"


def clear_punct(e: str) -> str:
    return (f"replace(regexp_replace({e}, {lit(fv.SYMBOL_CLASS)}, ' ', 'g'), "
            f"{lit(fv.LITERAL_SYMBOL_ENTRY)}, ' ')")


def expand_contractions(e: str, mapping: dict[str, str] | None = None) -> str:
    mapping = fv.CONTRACTIONS if mapping is None else mapping
    for q in fv.QUOTE_VARIANTS:
        e = f"replace({e}, {lit(q)}, '''')"
    keys = str_list(mapping.keys())
    vals = str_list(mapping.values())
    m = f"map({keys}, {vals})"
    return (f"array_to_string(list_transform(string_split({e}, ' '), "
            f"lambda t: coalesce({m}[t], t)), ' ')")


def remove_stopwords(e: str, stops: str = WC_STOPS) -> str:
    return f"array_to_string(list_filter({split_ws(e)}, lambda w: NOT list_contains({stops}, w)), ' ')"


def clean_text_no_lemma(e: str) -> str:
    c = replace_urls(replace_math(f"coalesce({e}, '')"))
    c = expand_contractions(clear_punct(c))
    return f"lower({remove_stopwords(c)})"


def words_for_ngrams(e: str) -> str:
    return f"list_filter({split_ws(f'lower({e})')}, lambda w: NOT list_contains({WC_STOPS}, w))"


def ngrams(e: str, n: int) -> str:
    if n == 1:
        return e
    return (f"(CASE WHEN len({e}) >= {n} THEN list_transform(range(1, len({e}) - {n - 2}), "
            f"lambda i: array_to_string({e}[i:i + {n - 1}], ' ')) ELSE [] END)")


def symbol_runs(e: str) -> str:
    return f"regexp_extract_all({e}, {lit(fv.NON_WORD_RUN)})"


ARTICLES = """
SELECT CAST(doc_id AS VARCHAR) AS cord_uid, doc_id,
       concat_ws(' ', lang, source) AS title,
       html AS abstract,
       text AS body_text, source AS journal,
       'author ' || CAST(doc_id % 97 AS VARCHAR) AS authors,
       CAST(CAST(DATE '2020-01-01' + CAST(doc_id % 97 AS INTEGER) AS DATE) AS VARCHAR) AS publish_time,
       'a/' || CAST(doc_id AS VARCHAR) || '.json; b/' || CAST(doc_id AS VARCHAR) || '.json' AS pdf_json_files
FROM documents LEFT JOIN pages ON page_id = doc_id
"""


def with_articles(body: str) -> str:
    return f"WITH articles AS ({ARTICLES}) {body}"


def flagship_ctes() -> str:
    """CTEs: sent, senttok, wv, tok, sdf, qcnt, qdf, nsent, sv (sentence vectors),
    qv (article-local question vectors), scores, top5."""
    d = "ZZ"
    hashed = ", ".join(f"md5(token || '{k}')" for k in range(HASHED_DIM // 16))
    return f"""
sent AS (
  SELECT doc_id, generate_subscripts(arr, 1) - 1 AS pos, unnest(arr) AS sentence
  FROM (SELECT doc_id, {split_sentences('text')} AS arr FROM documents)),
senttok AS (SELECT doc_id, pos, sentence, {sentence_tokens('sentence')} AS tokens FROM sent),
tokall AS (SELECT doc_id, pos, unnest(tokens) AS token FROM senttok),
q AS (SELECT item_id AS q_id, {sentence_tokens('text')} AS tokens FROM benchmark),
wh AS (SELECT token, concat({hashed}) AS h FROM (SELECT token FROM tokall UNION SELECT unnest(tokens) FROM q)),
wv AS (SELECT token, list_transform(range({HASHED_DIM}), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::INT - 127.5::DOUBLE) AS vec
       FROM wh),
tok AS (SELECT doc_id, pos, token, count(*) AS cnt FROM tokall WHERE token IN (SELECT token FROM wv)
        GROUP BY doc_id, pos, token),
sdf AS (SELECT doc_id, token, count(*) AS sdf FROM tok GROUP BY doc_id, token),
nq AS (SELECT count(*) AS nq FROM benchmark),
qcnt AS (SELECT q_id, token, count(*) AS cnt FROM (SELECT q_id, unnest(tokens) AS token FROM q)
         WHERE token IN (SELECT token FROM wv) GROUP BY q_id, token),
qdf AS (SELECT token, count(*) AS qdf FROM qcnt GROUP BY token),
nsent AS (SELECT doc_id, count(*) + (SELECT nq FROM nq) AS n FROM sent GROUP BY doc_id),
sw AS (SELECT t.doc_id, t.pos, t.token,
              t.cnt / sum(t.cnt) OVER (PARTITION BY t.doc_id, t.pos)
              * ln(n.n / (s.sdf + coalesce(qd.qdf, 0) + 1)) AS w
       FROM tok t JOIN sdf s USING (doc_id, token) LEFT JOIN qdf qd USING (token)
       JOIN nsent n USING (doc_id)),
swd AS (SELECT doc_id, pos, w, unnest(vec) AS x, generate_subscripts(vec, 1) AS {d}
        FROM sw JOIN wv USING (token)),
sv AS (SELECT doc_id, pos, list(v ORDER BY {d}) AS vec, sum(w) FILTER (WHERE {d} = 1) AS wsum
       FROM (SELECT doc_id, pos, {d}, sum(w * x) AS v, sum(w) AS w FROM swd GROUP BY doc_id, pos, {d})
       GROUP BY doc_id, pos),
qw AS (SELECT n.doc_id, c.q_id, c.token,
              c.cnt / sum(c.cnt) OVER (PARTITION BY n.doc_id, c.q_id)
              * ln(n.n / (coalesce(s.sdf, 0) + qd.qdf + 1)) AS w
       FROM nsent n CROSS JOIN qcnt c JOIN qdf qd ON qd.token = c.token
       LEFT JOIN sdf s ON s.doc_id = n.doc_id AND s.token = c.token),
qwd AS (SELECT doc_id, q_id, w, unnest(vec) AS x, generate_subscripts(vec, 1) AS {d}
        FROM qw JOIN wv USING (token)),
qv AS (SELECT doc_id, q_id, list(v ORDER BY {d}) AS vec, sum(w) FILTER (WHERE {d} = 1) AS wsum
       FROM (SELECT doc_id, q_id, {d}, sum(w * x) AS v, sum(w) AS w FROM qwd GROUP BY doc_id, q_id, {d})
       GROUP BY doc_id, q_id),
scores AS (
  SELECT s.doc_id, s.pos, q.q_id,
         round(CASE WHEN abs(s.wsum) > {1e-12} AND abs(q.wsum) > {1e-12}
                         AND list_dot_product(s.vec, s.vec) > 0 AND list_dot_product(q.vec, q.vec) > 0
                    THEN sign(s.wsum) * sign(q.wsum) * list_dot_product(s.vec, q.vec)
                         / (sqrt(list_dot_product(s.vec, s.vec)) * sqrt(list_dot_product(q.vec, q.vec)))
                    ELSE 0 END, {fv.SCORE_DECIMALS}) + 0.0 AS score
  FROM sv s JOIN qv q USING (doc_id)),
top5 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, q_id ORDER BY score DESC, pos) AS rn
                        FROM scores) WHERE rn <= {fv.TOP_SENTENCES_PER_QUESTION}),
relevant AS (SELECT t.doc_id, st.sentence, max(t.score) AS score
             FROM top5 t JOIN sent st USING (doc_id, pos) GROUP BY t.doc_id, st.sentence
             HAVING max(t.score) > {fv.SCORE_THRESHOLD})
"""


def flagship_sql() -> str:
    return "WITH " + flagship_ctes() + " SELECT doc_id, sentence, score FROM relevant"


def rules_values() -> str:
    return "(VALUES " + ", ".join(f"({i}, {lit(s)}, {lit(r)})" for i, (s, r) in enumerate(fv.NOUN_SUFFIX_RULES)) \
        + ") AS rules(r, suf, rep)"


def exceptions_values() -> str:
    return "(VALUES " + ", ".join(f"({lit(w)}, {lit(x)})" for w, x in fv.NOUN_EXCEPTIONS.items()) + ") AS e(word, lemma)"


def preprocess_ctes() -> str:
    """CTEs after ``articles``: cl (cleaned, no lemma), lem (word -> lemma), pre (preprocessed)."""
    return f"""
cl AS (SELECT doc_id, {clean_text_no_lemma('abstract')} AS a, {clean_text_no_lemma('body_text')} AS b FROM articles),
cw AS (SELECT doc_id, 'a' AS f, generate_subscripts(arr, 1) AS p, unnest(arr) AS word
       FROM (SELECT doc_id, {split_ws('a')} AS arr FROM cl)
       UNION ALL
       SELECT doc_id, 'b' AS f, generate_subscripts(arr, 1) AS p, unnest(arr) AS word
       FROM (SELECT doc_id, {split_ws('b')} AS arr FROM cl)),
nouns AS (SELECT DISTINCT unnest({split_ws(clean_text_no_lemma('text'))}) AS cand FROM benchmark),
vocab AS (SELECT DISTINCT word FROM cw),
cands AS (SELECT v.word, rules.r, left(v.word, length(v.word) - length(rules.suf)) || rules.rep AS cand
          FROM vocab v, {rules_values()} WHERE suffix(v.word, rules.suf)
          UNION ALL SELECT word, -1, word FROM vocab),
best AS (SELECT word, arg_min(cand, length(cand) * 1000 + r) AS lemma
         FROM cands WHERE cand IN (SELECT cand FROM nouns) GROUP BY word),
lem AS (SELECT v.word, coalesce(e.lemma, b.lemma) AS lemma FROM vocab v LEFT JOIN {exceptions_values()} USING (word)
        LEFT JOIN best b ON b.word = v.word WHERE coalesce(e.lemma, b.lemma) <> v.word),
pre AS (SELECT cl.doc_id,
          coalesce((SELECT string_agg(coalesce(l.lemma, w.word), ' ' ORDER BY w.p) FROM cw w
                    LEFT JOIN lem l ON l.word = w.word WHERE w.doc_id = cl.doc_id AND w.f = 'a'), '')
            AS preprocessed_abstract,
          coalesce((SELECT string_agg(coalesce(l.lemma, w.word), ' ' ORDER BY w.p) FROM cw w
                    LEFT JOIN lem l ON l.word = w.word WHERE w.doc_id = cl.doc_id AND w.f = 'b'), '')
            AS preprocessed_body_text
        FROM cl)
"""


def qvec_ctes() -> str:
    """After flagship CTEs: qvec (mean word vector of all question tokens, list)."""
    d = "ZZ"
    return f"""
jqt AS (SELECT unnest(tokens) AS token FROM q),
jqd AS (SELECT unnest(vec) AS x, generate_subscripts(vec, 1) AS {d} FROM jqt JOIN wv USING (token)),
qvec AS (SELECT list(v ORDER BY {d}) AS vec FROM (SELECT {d}, avg(x) AS v FROM jqd GROUP BY {d}))
"""


def cos_sql(a: str, b: str) -> str:
    return (f"round(list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * "
            f"sqrt(list_dot_product({b}, {b}))), {fv.SCORE_DECIMALS})")


def mean_vec_ctes(name: str, src: str, key: str) -> str:
    """``name``(key, vec): mean word vector of the token rows in ``src``(key, token)."""
    d = "ZZ"
    return f"""
{name}_d AS (SELECT {key}, unnest(vec) AS x, generate_subscripts(vec, 1) AS {d} FROM {src} JOIN wv USING (token)),
{name} AS (SELECT {key}, list(v ORDER BY {d}) AS vec FROM
           (SELECT {key}, {d}, avg(x) AS v FROM {name}_d GROUP BY {key}, {d}) GROUP BY {key})
"""
