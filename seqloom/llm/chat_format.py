"""Chat formatting with Spark expressions: collected turns, merged speakers, a reversible template and its loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The template. A block is START role NEWLINE text (NEXT text)* END; in roles and texts a backslash stands before each backslash and
# inside each "<|", in roles also before a newline, so no text holds a mark and every text can be read back.
START, NEXT, END = "<|start|>", "<|next|>", "<|end|>\n"
_UNESCAPE = r"(?s)\\(.)"
_HEAD = r"(?s)^((?:[^\\\n]|\\.)*+)\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1")


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, segments`` of every conversation of ``turns(conv_id, turn, role, text)``; other columns are ignored.

    Turns stand by ``turn`` (null first, then ties by role and text, so repeated rows are all kept). Neighbouring turns of one role share a block. ``segments``
    are the pieces of ``formatted`` in order, with ``loss`` true for texts of the assistant. A null role or text is empty; a null conv_id is a
    conversation of its own; an empty table gives no rows. One conversation is one row, so it must fit a task's memory; nothing else is gathered.
    """
    clean = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    gathered = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    at = lambda i: F.get(F.col("turns"), i)["role"]

    def pieces(t: Column, i: Column) -> Column:
        head = F.concat(F.lit(START), F.replace(escape(t["role"]), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
        opened = F.when(at(i - 1).eqNullSafe(t["role"]) & (i > 0), F.lit(NEXT)).otherwise(head)
        closed = F.when(at(i + 1).eqNullSafe(t["role"]), F.lit("")).otherwise(END)
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(part(opened, F.lit(False)), part(escape(t["text"]), t["role"] == "assistant"), part(closed, F.lit(False)))

    cut = gathered.select("conv_id", F.flatten(F.transform("turns", pieces)).alias("segments"))
    return cut.select("conv_id", F.array_join("segments.text", "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, ``array<struct<role, text>>``."""
    blocks = F.slice(F.split(formatted, r"<\|start\|>", -1), 2, 1 << 30)

    def turns(block: Column) -> Column:
        role = unescape(F.regexp_extract(block, _HEAD, 1))
        body = F.regexp_replace(F.regexp_replace(block, _HEAD, ""), r"<\|end\|>\n$", "")
        return F.transform(F.split(body, r"<\|next\|>", -1), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def digest(chats: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, all read back from formatted conversations."""
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    read = chats.select("conv_id", read_turns(F.col("formatted")).alias("turns"), loss.alias("loss"), F.length("formatted").cast("bigint").alias("formatted_chars"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
