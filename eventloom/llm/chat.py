"""Chat formatting with typed content parts.

A turn's content is a list of parts, each text, image, audio or document.  A visitor over the parts
writes texts escaped and every attachment as a placeholder; the n-th placeholder of a conversation
belongs to the n-th entry of its attachments, which keeps the reference and the tokens it expands to.

The template, with raw '<' only in its own marks:

    <turn:ROLE>\\n BODY </turn>\\n        (no blanks around BODY)

In texts '\\' becomes '\\\\' and '<' becomes '\\l'; in roles '>' becomes '\\g' too.  The escape is
reversible, as every backslash of an escaped string starts a pair.

Defined results: a null text or role is empty; null turns sort first; equal turns are ordered by
role, then content; a null conversation id is one conversation; unknown part types count as
documents; texts are formatted whole, however long; an empty table gives an empty result.  Only the
named columns are read, so others' names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,units:int>"
#: Tokens an attachment expands to: a fixed part and a part for each unit (image tile, audio second, document page).
TOKENS = {"image": (85, 170), "audio": (4, 25), "document": (16, 512)}
#: Turns whose text is trained on.
LOSS_ROLES = ("assistant",)
TURN_END = "</turn>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(">"), F.lit("\\g"))


def unescaped(text: Column) -> Column:
    """Pairs of backslashes split the string, so what is left between them holds only the letter escapes."""
    plain = F.transform(F.split(text, r"\\\\"), lambda x: F.replace(F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")))
    return F.array_join(plain, "\\")


def text_parts(text: str | Column) -> Column:
    """One text part: how plain rows enter the formatter."""
    col = F.col(text) if isinstance(text, str) else text
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(col, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(0).alias("units")))


def part_kind(part: Column) -> Column:
    return F.when(part["type"] == "text", "text").when(part["type"].isin("image", "audio"), part["type"]).otherwise("document")


def part_plain(part: Column) -> Column:
    """What equal turns are ordered by: a text as it is, an attachment as its placeholder."""
    kind = part_kind(part)
    return F.when(kind == "text", F.coalesce(part["text"], F.lit(""))).otherwise(F.concat(F.lit("<"), kind, F.lit("/>")))


def part_body(part: Column) -> Column:
    kind = part_kind(part)
    return F.when(kind == "text", escaped(F.coalesce(part["text"], F.lit("")))).otherwise(F.concat(F.lit("<"), kind, F.lit("/>")))


def part_attachment(part: Column) -> Column:
    kind, units = part_kind(part), F.coalesce(part["units"], F.lit(0))
    tokens = F.coalesce(*[F.when(kind == k, F.lit(fixed) + units * each) for k, (fixed, each) in TOKENS.items()])
    return F.struct(kind.alias("kind"), part["ref"].alias("ref"), tokens.cast("long").alias("tokens"))


def formatted_chats(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """One row per conversation: n_turns, formatted, loss_spans, attachments, expanded_tokens.

    loss_spans holds (start, chars) in code points of formatted, one per turn under the loss mask.
    One shuffle, on the conversation; a conversation is one row of output by definition.
    """
    items = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>"))
    rows = messages.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.array_join(F.transform(items, part_plain), "").alias("plain"),
        F.array_join(F.transform(items, part_body), "").alias("body"),
        F.transform(F.filter(items, lambda p: part_kind(p) != "text"), part_attachment).alias("attached"),
    )
    head = F.concat(F.lit("<turn:"), escaped_role(F.col("role")), F.lit(">\n"))
    rows = rows.withColumn("head", F.length(head)).withColumn("piece", F.concat(head, "body", F.lit(TURN_END)))
    order = Window.partitionBy("conv").orderBy("turn", "role", "plain", "body")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.select(
        "conv", "role", "piece", "attached", F.row_number().over(order).alias("n"),
        (F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.col("head")).alias("start"), F.length("body").cast("long").alias("chars"),
    )
    turns = F.col("turns")
    one = (
        placed.groupBy("conv")
        .agg(F.sort_array(F.collect_list(F.struct("n", "role", "piece", "attached", "start", "chars"))).alias("turns"))
    )
    spoken = F.filter(turns, lambda t: t["role"].isin(*LOSS_ROLES))
    attachments = F.flatten(F.transform(turns, lambda t: F.transform(t["attached"], lambda a: F.struct((t["n"] - 1).alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    return one.select(
        F.col("conv").alias(conv_id),
        F.size(turns).cast("long").alias("n_turns"),
        F.array_join(F.transform(turns, lambda t: t["piece"]), "").alias("formatted"),
        F.transform(spoken, lambda t: F.struct(t["start"].alias("start"), t["chars"].alias("chars"))).alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("expanded_tokens"),
    )


def parsed_turns(formatted: str | Column) -> Column:
    """The turns read back from a formatted conversation: array of (role, text), texts unescaped.

    Placeholders of attachments stay as they are written.
    """
    col = F.col(formatted) if isinstance(formatted, str) else formatted
    pieces = F.split(col, TURN_END)
    return F.transform(
        F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.struct(
            unescaped(F.substring_index(F.substring(p, 7, 1 << 30), ">\n", 1)).alias("role"),
            unescaped(p.substr(F.locate(">\n", p) + 2, F.length(p))).alias("text"),
        ),
    )


def loss_text(formatted: str, spans: str) -> Column:
    """All text under the loss mask, unescaped, in order with nothing between."""
    return F.array_join(F.transform(F.col(spans), lambda s: unescaped(F.col(formatted).substr((s["start"] + 1).cast("int"), s["chars"].cast("int")))), "")
