"""Chat formatting with typed content parts, as column expressions.

A message holds an ordered list of parts: text, image, audio or document. A visitor over the parts writes texts
escaped and every other part as a placeholder ``<|kind|>``, in order; the attachments are listed in the same order
with their reference, turn and expanded token count, so the i-th placeholder of a conversation is its i-th attachment.

Template: ``<|turn|>role\\ncontent<|end|>`` per message. Control strings start with ``<`` or ``[``; inside texts
``\\`` becomes ``\\\\``, ``<`` becomes ``\\l`` and ``[`` becomes ``\\b`` (and a line end in a role ``\\n``), so no
control string of this or another template survives in a text, and the escape is undone without loss.

Edge cases: null text is empty, null role is empty, null part lists are empty, unknown part kinds become
``<|kind|>`` placeholders of one token; turns sort by (turn, role, content), repeated rows stay; null conversation ids form one
conversation; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|turn|>", "<|end|>"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 512


def escape(t: Column) -> Column:
    t = F.replace(F.coalesce(t, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(t, F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def unescape(t: Column) -> Column:
    plain = lambda s: F.replace(F.replace(F.replace(s, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")),
                                F.lit("\\n"), F.lit("\n"))
    return F.array_join(F.transform(F.split(t, r"\\\\"), plain), "\\")


def text_part(t: Column) -> Column:
    """A message's text as a list of one text part."""
    none = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("kind"), t.alias("text"), none.cast("string").alias("ref"),
                            none.cast("int").alias("width"), none.cast("int").alias("height"),
                            none.cast("double").alias("seconds"), none.cast("int").alias("pages")))


def token_count(p: Column) -> Column:
    """Tokens that a placeholder expands to: image patches, audio frames, document pages; at least one."""
    size = (F.when(p["kind"] == "image", F.ceil(p["width"] / PATCH) * F.ceil(p["height"] / PATCH))
            .when(p["kind"] == "audio", F.ceil(p["seconds"] * AUDIO_RATE))
            .when(p["kind"] == "document", p["pages"] * PAGE_TOKENS))
    return F.greatest(F.coalesce(size.cast("long"), F.lit(1).cast("long")), F.lit(1).cast("long"))


def _kind(p: Column) -> Column:
    return F.coalesce(p["kind"], F.lit("part"))


def visit(parts: Column) -> Column:
    """Content of a message: escaped texts and placeholders in order."""
    return F.array_join(F.transform(parts, lambda p: F.when(_kind(p) == "text", escape(p["text"])).otherwise(
        F.concat(F.lit("<|"), escape(_kind(p)), F.lit("|>")))), "")


def chat_format(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                parts: str = "parts", train_role: str = "assistant") -> DataFrame:
    """One row per conversation: (conv_id, formatted, loss_spans, attachments, n_expanded).

    ``loss_spans`` are (start, len) code point spans of ``formatted``: the contents of ``train_role`` messages.
    ``n_expanded`` sums the token counts of all attachments.
    """
    p = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>"))
    rendered = messages.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.replace(escape(F.col(role)), F.lit("\n"), F.lit("\\n")).alias("role"),
        (F.coalesce(F.col(role), F.lit("")) == train_role).alias("train"), visit(p).alias("content"),
        F.transform(F.filter(p, lambda x: _kind(x) != "text"), lambda x: F.struct(
            F.col(turn).alias("turn"), _kind(x).alias("kind"), x["ref"].alias("ref"),
            token_count(x).alias("tokens"))).alias("files"))
    turns = rendered.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("turn", "role", "content", "train", "files"))).alias("ts"))
    text = F.array_join(F.transform("ts", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["content"],
                                                             F.lit(CLOSE))), "")
    span = "array<struct<start:long,len:long>>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(span).alias("out"))

    def step(acc: Column, t: Column) -> Column:
        lo = acc["at"] + len(OPEN) + 1 + F.length(t["role"])
        n = F.length(t["content"]).cast("long")
        return F.struct((lo + n + len(CLOSE)).cast("long").alias("at"), F.when(t["train"], F.concat(
            acc["out"], F.array(F.struct(lo.cast("long").alias("start"), n.alias("len"))))).otherwise(acc["out"]).alias("out"))

    files = F.flatten(F.transform("ts", lambda t: t["files"]))
    return turns.select("conv_id", text.alias("formatted"), F.aggregate("ts", start, step, lambda a: a["out"]).alias("loss_spans"),
                        files.alias("attachments"),
                        F.aggregate(files, F.lit(0).cast("long"), lambda s, f: s + f["tokens"]).alias("n_expanded"))


def parse_turns(formatted: Column) -> Column:
    """Messages read back from a formatted conversation: array of (role, text)."""
    whole = F.split(formatted, r"<\|end\|>")
    turns = F.slice(whole, F.lit(1), F.size(whole) - 1)

    def read(t: Column) -> Column:
        head = F.split_part(t, F.lit("\n"), F.lit(1))
        return F.struct(unescape(F.substr(head, F.lit(len(OPEN) + 1))).alias("role"),
                        unescape(F.substr(t, F.length(head) + 2)).alias("text"))

    return F.transform(turns, read)


def digest(chats: DataFrame) -> DataFrame:
    """Digest columns, read back from ``formatted`` and its loss spans."""
    read = chats.withColumn("turns", parse_turns(F.col("formatted")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["len"].cast("int")))), "")
    return (read.withColumn("loss", loss)
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))
