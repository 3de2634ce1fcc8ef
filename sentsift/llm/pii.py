"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Column expressions only. A pattern's matches and the text between them give code point offsets, so that no text is
walked in Python. Four base kinds (email, ip, card, phone) always stay when their own check passes (ip parts, Luhn,
digit counts). Proposals of the further kinds start from a prior, gain ``CONFIRMED`` from a passing checksum (mod-97
for iban, the mix of characters for keys and secrets) and ``CONTEXT`` when a word of their kind stands within ``NEAR`` characters; they stay from ``ACCEPT`` on
and only where no base span lies.

Patterns are written without backtracking (possessive runs, a lookbehind that starts at a run's first character), so
texts of any length cost linear time; they match what the plain forms in the comments match.

Edge cases: null and empty texts have no spans; repeated rows are judged alike; nothing is shuffled, so hot keys,
null ids and extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "local_phone", "key", "secret")

#: Plain forms: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ ; [0-9]+(\.[0-9]+){3} ; [0-9]([\x20-]?[0-9])+ ;
#: \+[0-9][\x20().0-9-]+[0-9]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "key": (r"(?<![A-Za-z0-9_-])(?:A(?:KIA|SIA)[0-9A-Z]{16}|sk-[A-Za-z0-9_-]{16,}|gh[pousr]_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}"
            r"|AIza[0-9A-Za-z_-]{35}|glpat-[0-9A-Za-z_-]{20,}|[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9_-])"),
    "secret": (r"(?i)(?<![a-z0-9])(?:[a-z0-9_]{0,30}_)?(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key)"
               r"[a-z0-9_]{0,30}[\"']?\x20?[=:]\x20?[\"']?[^\s\"']{6,}+[\"']?"),
    "local_phone": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: A text without this sign has no match.
HINT = {"email": "@", "phone": "+"}
PRIOR = {"iban": 0.3, "ssn": 0.3, "local_phone": 0.3, "key": 0.3, "secret": 0.3}
CONTEXT_WORDS = {
    "iban": r"(?i)\b(?:iban|bic|account|konto|compte|cuenta)\b",
    "ssn": r"(?i)\b(?:ssn|social security)\b",
    "local_phone": r"(?i)\b(?:phone|tel|call|fax|mobile|telefon|téléphone|teléfono)\b",
    "key": r"(?i)(?:key|token|secret|credential|password|auth|bearer)",
    "secret": r"(?i)\b(?:login|user|credential|auth|config|env)",
    "email": r"(?i)\b(?:e-?mail|contact|write)\b",
    "ip": r"(?i)\b(?:ip|host|server|address)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(?:phone|tel|call|fax|mobile|telefon|téléphone|teléfono)\b",
}
CONFIRMED, CONTEXT, ACCEPT, NEAR = 0.4, 0.3, 0.6, 40
SPAN = "array<struct<start:long,stop:long,text:string>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Luhn check of the digits in a string."""
    d = F.reverse(_digits(m))
    twice = lambda x: F.when(x > 9, x - 9).otherwise(x)
    value = lambda i: F.substring(d, i, F.lit(1)).cast("int")
    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda s, i: s + F.when(
        i % 2 == 0, twice(value(i) * 2)).otherwise(value(i)))
    return (F.length(d) > 0) & (total % 10 == 0)


def mod97(m: Column) -> Column:
    """IBAN check: first four characters last, letters as 10 to 35, remainder 1."""
    s = F.upper(F.regexp_replace(m, " ", ""))
    turned = F.concat(F.substr(s, F.lit(5)), F.left(s, F.lit(4)))
    value = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(
        (a * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97))
    return rest == 1


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        # Leading zeros do not count; at most three digits are left, so the cast holds.
        return F.forall(F.split(m, r"\."), lambda p: p.rlike("^0*[0-9]{1,3}$") & (
            F.right(p, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return F.length(_digits(m)).between(13, 19) & luhn(m)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def spans(text: Column, kind: str) -> Column:
    """Valid spans of one kind as array of (start, stop, text); code points, stop exclusive."""
    t = F.coalesce(text, F.lit(""))
    pattern = PATTERNS[kind]
    none = F.array().cast(SPAN)
    pieces = F.arrays_zip(F.split(t, pattern, -1).alias("gap"), F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("hit"))
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))

    def step(acc: Column, p: Column) -> Column:
        lo = acc["at"] + F.length(p["gap"])
        hi = lo + F.coalesce(F.length(p["hit"]), F.lit(0))
        return F.struct(hi.cast("long").alias("at"), F.when(
            p["hit"].isNotNull() & valid(kind, p["hit"]),
            F.concat(acc["out"], F.array(F.struct(lo.cast("long").alias("start"), hi.cast("long").alias("stop"),
                                                  p["hit"].alias("text"))))).otherwise(acc["out"]).alias("out"))

    sign = t.contains(HINT[kind]) if kind in HINT else t.rlike("[0-9]")
    return F.when(sign, F.aggregate(pieces, start, step, lambda a: a["out"])).otherwise(none)


def random_looking(m: Column) -> Column:
    """Whether a string is a known kind of key or as mixed as a random one: letters and digits, many different ones."""
    value = F.regexp_replace(F.regexp_replace(m, r"^[^=:]*[=:]\x20?", ""), "[\"']", "")
    different = F.size(F.array_distinct(F.split(value, "")))
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (different * 4 >= F.least(F.length(value), F.lit(32)))
    named = m.rlike(r"^(?:AKIA|ASIA|sk-|gh[pousr]_|xox|AIza|glpat-)") & (different >= 8)
    return named | mixed | m.rlike(r"(?i)(?:password|passwd|pwd|passphrase)[a-z0-9_]*[\"']?\x20?=")


def _near(text: Column, kind: str, s: Column) -> Column:
    lo = F.greatest(s["start"] - NEAR, F.lit(0))
    around = F.concat(F.substr(text, (lo + 1).cast("int"), (s["start"] - lo).cast("int")), F.lit(" "),
                      F.substr(text, (s["stop"] + 1).cast("int"), F.lit(NEAR)))
    return around.rlike(CONTEXT_WORDS[kind])


#: Checks that confirm the added kinds; a span that fails its check is dropped.
CHECKS = {"iban": mod97, "key": random_looking, "secret": random_looking}


def _score(kind: str, found: Column, t: Column, base: Column) -> Column:
    """Scored spans of one kind; added kinds keep those from ``ACCEPT`` on that no base span overlaps."""
    def rate(s: Column) -> Column:
        score = F.lit(PRIOR.get(kind, 0.7)) + F.when(_near(t, kind, s), CONTEXT).otherwise(0.0)
        if kind in CHECKS:
            score = score + F.when(CHECKS[kind](s["text"]), CONFIRMED).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"),
                        s["text"].alias("text"), score.alias("score"))

    def stays(s: Column) -> Column:
        taken = F.exists(base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
        # An iban that fails its checksum, or a plain word as a secret, is none, whatever stands near it.
        return (s["score"] >= ACCEPT) & ~taken & (CHECKS[kind](s["text"]) if kind in CHECKS else F.lit(True))

    rated = F.transform(found, rate)
    return rated if kind in BASE_KINDS else F.filter(rated, stays)


def find_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``docs`` with ``out_col``: array of (kind, start, stop, text, score), base kinds first, then by kind and start.

    A column of the table called ``out_col`` is replaced; all others stay.
    """
    t = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    kinds, held = (*BASE_KINDS, *ADDED_KINDS), _free_name(docs, "__spans")
    marked = docs.withColumn(held, F.struct(*(spans(t, kind).alias(kind) for kind in kinds)))
    base = F.flatten(F.array(*(F.col(held)[k] for k in BASE_KINDS)))
    scored = [_score(kind, F.col(held)[kind], t, base) for kind in kinds]
    return marked.withColumn(out_col, F.flatten(F.array(*scored))).drop(held)


def _free_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``[KIND]``; overlapping spans go as one, named by the first."""
    t, held = F.col(f"`{text_col}`"), _free_name(docs, "__pii")
    marked = find_pii(docs, text_col, held)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        hit = s["start"] >= acc["at"]
        piece = F.concat(F.substr(t, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                         F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"),
                        F.when(hit, F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"))

    ordered = F.array_sort(F.transform(held, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"),
                                                                 s["kind"].alias("kind"))))
    clean = F.aggregate(ordered, start, step, lambda a: F.concat(
        F.array_join(a["out"], ""), F.substr(t, (a["at"] + 1).cast("int"))))
    return marked.withColumn(text_col, F.when(F.size(held) > 0, clean).otherwise(t)).drop(held)


def digest(marked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, hash of the base spans, all spans as text, and their scores in the same order."""
    show = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                       s["stop"].cast("string"))), ",")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda k: F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [count(k) for k in BASE_KINDS]
    return marked.select(F.col(id_col).alias("doc_id"), *counts, F.sha2(show(base), 256).alias("base_sha256"),
                         show("pii").alias("spans"),
                         F.array_join(F.transform("pii", lambda s: F.round(s["score"], 2).cast("string")), ",").alias("scores"))
