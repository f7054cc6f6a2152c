"""Chat formatting: typed content parts flattened into one string a conversation.

A turn has content parts (type, text, ref, n_tokens). A visitor goes over them in
order: neighbouring texts are put together and then escaped, so what is in several
parts can't add up to a control string; other parts become placeholders, whose
references and token counts are recorded in the same order: the k-th placeholder of a
conversation is its k-th attachment. Control strings begin with ``<|``; in
texts and roles each backslash is doubled and ``<|`` becomes ``<\\|``, so no text
can hold a control string and the escape can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
PART_TOKENS = {"image": 256, "audio": 128, "document": 512}
PART = "struct<type:string,text:string,ref:string,n_tokens:bigint>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """The parts of a turn that is nothing but text."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("n_tokens")))


def _is_attachment(part: Column) -> Column:
    return part["type"].isin(*PART_TOKENS)


def _content(parts: Column) -> Column:
    """What the parts of a turn are in the formatted turn. Unknown and missing types count as text.

    The visitor holds what is written so far and the text that is still open: a text
    part goes to the open text, any other ends it.
    """

    def visit(held: Column, part: Column) -> Column:
        placed = F.struct(F.concat(held["done"], escape(held["open"]), F.lit("<|"), part["type"], F.lit("|>")).alias("done"), F.lit("").alias("open"))
        read = F.struct(held["done"].alias("done"), F.concat(held["open"], F.coalesce(part["text"], F.lit(""))).alias("open"))
        return F.when(_is_attachment(part), placed).otherwise(read)

    nothing = F.struct(F.lit("").alias("done"), F.lit("").alias("open"))
    return F.aggregate(parts, nothing, visit, lambda held: F.concat(held["done"], escape(held["open"])))


def _attachments(parts: Column) -> Column:
    """(part, type, ref, n_tokens) of each placeholder of a turn; n_tokens falls back on the type's usual count."""
    usual = F.create_map(*(F.lit(x) for kv in PART_TOKENS.items() for x in kv))
    placed = F.transform(parts, lambda p, j: F.struct(j.alias("part"), p["type"].alias("type"), p["ref"].alias("ref"), F.coalesce(p["n_tokens"], usual[p["type"]].cast("bigint")).alias("n_tokens")))
    return F.filter(placed, _is_attachment)


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts", loss_role: str = "assistant") -> DataFrame:
    """A row a conversation: its id, formatted, loss_mask, attachments and expanded_tokens.

    formatted: each turn, by ascending turn, as TURN role SAYS content END.
    loss_mask: (turn, start, length) of the content of each turn of ``loss_role``,
    in code points of the piece after TURN. Null roles and texts are empty; null
    parts are a turn without content. Equal turn numbers are ordered by role, then
    content, repeated rows kept. A null id is a conversation. No rows give none.
    """
    parts = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>"))
    own = turns.select(
        F.col(conv_col),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), _content(parts).alias("content"), _attachments(parts).alias("parts")).alias("t"),
    )
    grouped = own.groupBy(conv_col).agg(F.sort_array(F.collect_list("t")).alias("turns"))
    whole = lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(SAYS), t["content"], F.lit(END))
    span = lambda t, i: F.struct(i.alias("turn"), (F.length(escape(t["role"])) + len(SAYS)).alias("start"), F.length(t["content"]).alias("length"), (t["role"] == loss_role).alias("on"))
    mask = F.transform(F.filter(F.transform(F.col("turns"), span), lambda s: s["on"]), lambda s: F.struct(s["turn"], s["start"], s["length"]))
    attachments = F.flatten(F.transform("turns", lambda t, i: F.transform(t["parts"], lambda a: F.struct(i.alias("turn"), a["part"].alias("part"), a["type"].alias("type"), a["ref"].alias("ref"), a["n_tokens"].alias("n_tokens")))))
    told = grouped.select(conv_col, F.array_join(F.transform("turns", whole), "").alias("formatted"), mask.alias("loss_mask"), attachments.alias("attachments"))
    return told.withColumn("expanded_tokens", F.aggregate(F.col("attachments"), F.lit(0).cast("bigint"), lambda n, a: n + a["n_tokens"]))


def read_turns(formatted: Column) -> Column:
    """(role, text) of each turn of a formatted string."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p: p != "")

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, SAYS, 1)
        text = F.substring(piece, F.length(role) + len(SAYS) + 1, F.length(piece) - F.length(role) - len(SAYS) - len(END))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, loss_mask: Column) -> Column:
    """The texts under the loss mask."""
    split = F.transform(F.array(F.slice(F.split(formatted, r"<\|turn\|>"), 2, 1 << 30)), lambda pieces: F.transform(loss_mask, lambda s: unescape(F.substring(F.get(pieces, s["turn"]), s["start"] + 1, s["length"]))))
    return split[0]
