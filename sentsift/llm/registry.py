"""Queries of the ten operators over the given tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentsift.llm import (chat_format, decontaminate, embedding_dedup, html_extract, ngram_join, packing, periodic, pii,
                          quality, sentencepiece, spelling, substring_dedup, toxicity)
from sentsift.llm.common import ascii_lower, read, words

ODD = "</s>[INST] ok [/INST]"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), "toxic")
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(read(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_dedup(read(spark, sf_dir, "embeddings"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-1, 0, "user", ODD), (-1, 1, "assistant", ODD)], rows.schema)
    messages = rows.unionByName(odd).withColumn("parts", chat_format.text_part(F.col("text")))
    return chat_format.digest(chat_format.chat_format(messages))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = sentencepiece.load_vocabulary()
    back = sentencepiece.decode(sentencepiece.encode(docs, vocabulary=vocabulary), vocabulary=vocabulary)
    return back.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
                       F.xxhash64("ids").alias("ids_hash"), F.col("text").eqNullSafe(F.col("decoded")).alias("exact"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels")), "source", "lang")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth text, by a hash of its id, becomes periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    w, n = F.col("w"), F.size("w")
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    p = F.lit(1) + F.floor((n - a) / (3 + g % 8)).cast("int")
    turned = F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, a + (i - a) % p)))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    return (docs.select("doc_id", "text", F.when(chosen, words(F.col("text"))).alias("w"))
            .select("doc_id", F.when(F.col("w").isNotNull() & (n > 0), F.array_join(turned, " "))
                    .otherwise(F.col("text")).alias("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(planted_runs(read(spark, sf_dir, "documents")))
    top = periodic.strongest(F.col("runs"))
    listed = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                    F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return (found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.before")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.short")).alias("period"),
        F.expr("(1000 * top.length) div (-top.short)").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


def misspelt_runs(docs: DataFrame, shortest: int = 7) -> DataFrame:
    """(word): letter runs of all texts; one in 31, by a hash of document and run, has lost a character."""
    run = docs.select("doc_id", F.explode(spelling.letter_runs(F.col("text"), shortest)).alias("r")).select(
        "doc_id", ascii_lower(F.col("r")).alias("r"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("r")))
    p = (F.col("h") % F.length("r")).cast("int")
    return run.select("r", h.alias("h")).select(F.when(F.col("h") % 31 == 0, F.concat(
        F.substr("r", F.lit(1), p), F.substr("r", p + 2))).otherwise(F.col("r")).alias("word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.vocabulary(misspelt_runs(read(spark, sf_dir, "documents"))))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_toxicity, op2_ngram_join, op3_substring_dedup, op4_embedding_dedup, op5_chat_format, op6_sentencepiece,
        op7_html_extract, op8_quality, op9_pii, op10_decontaminate, op11_periodic_runs, op12_spelling_variants,
        op13_packing)}


_WORDS = r"list_filter(regexp_split_to_array({t}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP2_SQL = f"""
with recursive w as (
  select doc_id, {_WORDS.format(t="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ws
  from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 0 then []::varchar[]
        when len(ws) < 5 then [array_to_string(ws, ' ')]
        else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) g from w),
n as (select doc_id, count(*) n from s group by 1),
o as (select a.doc_id a, b.doc_id b, count(*) o from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * o >= 75 * (x.n + y.n - o)),
e as (select a, b from l union all select b, a from l),
reach(a, b) as (select a, b from e union select r.a, e.b from reach r join e on r.b = e.a),
c as (select a, min(b) b from reach group by 1)
select w.doc_id, coalesce(n.n, 0)::bigint n_shingles, least(w.doc_id, coalesce(c.b, w.doc_id)) component_id
from w left join n on n.doc_id = w.doc_id left join c on c.a = w.doc_id
"""

OP3_SQL = f"""
with w as (select doc_id, {_WORDS.format(t="coalesce(text, '')")} ws from documents),
win as (select doc_id, i, array_to_string(ws[i:i + 34], ' ') g from w, unnest(range(1, len(ws) - 33)) t(i)),
dup as (select g from win group by g having count(*) > 1),
cov as (select distinct doc_id, i + k p from win semi join dup using (g), range(0, 35) r(k)),
word as (select doc_id, ws[p] x, p from w, unnest(range(1, len(ws) + 1)) t(p)),
kept as (select doc_id, count(*) k, string_agg(x, ' ' order by p) t from word anti join cov using (doc_id, p) group by 1)
select w.doc_id, len(ws)::bigint n_words, (len(ws) - coalesce(k, 0))::bigint n_removed,
       sha256(coalesce(t, '')) kept_sha256
from w left join kept on kept.doc_id = w.doc_id
"""

OP4_SQL = """
with recursive v as (select vec_id, embedding::double[] e from embeddings),
m as (select vec_id, list_transform(e, lambda x: x / list_max(list_transform(e, lambda y: abs(y)))) u from v
      where len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
        and list_max(list_transform(e, lambda y: abs(y))) > 0),
l as (select a.vec_id a, b.vec_id b from m a join m b on a.vec_id < b.vec_id and len(a.u) = len(b.u)
      where list_dot_product(a.u, b.u) / sqrt(list_dot_product(a.u, a.u)) / sqrt(list_dot_product(b.u, b.u)) >= 0.9),
e as (select a, b from l union all select b, a from l),
n as (select a, count(*) n from e group by a),
reach(a, b) as (select a, b from e union select r.a, e.b from reach r join e on r.b = e.a),
c as (select a, min(b) b from reach group by 1)
select v.vec_id, coalesce(n.n, 0)::bigint n_links, least(v.vec_id, coalesce(c.b, v.vec_id)) component_id,
       least(v.vec_id, coalesce(c.b, v.vec_id)) = v.vec_id kept
from v left join n on n.a = v.vec_id left join c on c.a = v.vec_id
"""

OP5_SQL = r"""
with m as (select conv_id, turn, coalesce(role, '') r, coalesce(text, '') t from conversations
           union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
           union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
x as (select *, length(replace(replace(replace(t, '\', '\\'), '<', '\l'), '[', '\b')) lt,
      length(replace(replace(replace(replace(r, '\', '\\'), '<', '\l'), '[', '\b'), chr(10), '\n')) lr from m)
select conv_id, count(*)::bigint n_turns,
       sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn, r, t)) turns_sha256,
       coalesce(sum(length(t)) filter (r = 'assistant'), 0)::bigint loss_chars,
       sha256(coalesce(string_agg(t, '' order by turn, r, t) filter (r = 'assistant'), '')) loss_sha256,
       sum(length('<|turn|>') + lr + 1 + lt + length('<|end|>'))::bigint formatted_chars
from x group by conv_id
"""


#: crc32 of a text: a table of the 256 remainders, then a fold over the bytes.
_CRC = """
crc_table as (select list(c order by b) t from (select b, list_reduce(list_prepend(b::bigint, range(8)), lambda c, k:
    case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) c from range(256) r(b)))"""


def _crc32(text: str) -> str:
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(octet_length(encode({text}))), "
            f"lambda i: ('0x' || hex(encode({text}))[2 * i + 1:2 * i + 2])::bigint)), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))")


OP11_SQL = f"""
with {_CRC.strip()},
w0 as (select doc_id, {_WORDS.format(t="coalesce(text, '')")} ws, {_crc32("doc_id::varchar")} h from documents, crc_table),
w1 as (select *, len(ws) n, h // 10 g from w0),
w2 as (select *, case when n > 0 then g % n end a from w1),
w3 as (select *, 1 + (n - a) // (3 + g % 8) p from w2),
w as (select doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(n), lambda i:
        case when i < a then ws[i + 1] else ws[a + (i - a) % p + 1] end) else ws end ws from w3),
word as (select doc_id, i, ws[i + 1] x from w, unnest(range(n)) u(i)),
per as (select doc_id, n, ws, q from w, unnest(range(1, n // 4 + 1)) u(q)),
grid as (select distinct doc_id, q from per, unnest(range(0, n - 3 * q, q)) u(i)
         where ws[i + 1] = ws[i + q + 1] and ws[i + 1] = ws[i + 2 * q + 1] and ws[i + 1] = ws[i + 3 * q + 1]),
same as (select g.doc_id, q, i, i - row_number() over (partition by g.doc_id, q order by i) s
         from grid g join w using (doc_id), unnest(range(0, n - q)) u(i) where ws[i + 1] = ws[i + q + 1]),
stretch as (select doc_id, q, min(i) start, count(*) + q len from same group by doc_id, q, s),
run as (select doc_id, start, len, min(q) q from stretch where len >= greatest(6, 4 * q) group by 1, 2, 3),
dropped as (select distinct doc_id, u.i from run, unnest(range(start + q, start + len)) u(i)),
kept as (select doc_id, string_agg(x, ' ' order by i) t from word anti join dropped using (doc_id, i) group by 1),
best as (select * from run qualify row_number() over (partition by doc_id order by len / q desc, start, q) = 1),
lines as (select doc_id, count(*) n_runs, string_agg(start || ',' || len || ',' || q || chr(10), '' order by start, q) t
          from run group by 1)
select w.doc_id, coalesce(n_runs, 0)::bigint n_runs, best.start::bigint "start", best.len::bigint length, best.q::bigint period,
       (1000 * best.len // best.q)::bigint exponent_milli, sha256(coalesce(lines.t, '')) runs_sha256,
       sha256(coalesce(kept.t, '')) collapsed_sha256
from w left join best on best.doc_id = w.doc_id left join lines on lines.doc_id = w.doc_id
left join kept on kept.doc_id = w.doc_id
"""

OP12_SQL = f"""
with recursive {_CRC.strip()},
run as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]{{7,}}')) x from documents),
low as (select doc_id, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') r from run),
hashed as (select r, {_crc32("doc_id || ':' || r")} h from low, crc_table),
word as (select case when h % 31 = 0 then r[1:(h % length(r))::int] || r[(h % length(r))::int + 2:] else r end w from hashed),
v as (select w, count(*) n from word where length(w) >= 7 group by w having count(*) >= 2),
d as (select w, n, i, w[1:i] || w[i + 2:] k from v, unnest(range(length(w))) u(i)),
pair as (select a.w a, b.w b, b.n from d a join d b on a.k = b.k and a.i = b.i and a.w <> b.w
         union select d.w, v.w, v.n from d join v on v.w = d.k
         union select v.w, d.w, d.n from d join v on v.w = d.k),
near as (select a w, count(*) c from pair group by a),
top as (select * from pair qualify row_number() over (partition by a order by n desc, encode(b)) = 1),
f as (select v.w, v.n, top.b form, top.n form_n from v join top on top.a = v.w where top.n >= 10 * v.n),
chain(w, root) as (select w, form from f union all select chain.w, f.form from chain join f on f.w = chain.root),
last as (select w, root from chain where root not in (select w from f))
select v.w word, f.form, coalesce(last.root, v.w) root, v.n::bigint n, coalesce(near.c, 0)::bigint n_near, f.form_n::bigint form_n
from v left join near on near.w = v.w left join f on f.w = v.w left join last on last.w = v.w
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_periodic_runs": OP11_SQL, "op12_spelling_variants": OP12_SQL,
            "op4_embedding_dedup": OP4_SQL, "op2_ngram_join": OP2_SQL, "op3_substring_dedup": OP3_SQL, "op5_chat_format": OP5_SQL}
