"""Chat formatting with a grammar round trip. DataFrame operations only.

Grammar: conversation = turn*, turn = ``<s>`` role ``[INST]`` text ``[/INST]</s>``.
The four marks are control strings. A text that the parser would read back otherwise
is escaped: each control-like run (an opening bracket, any number of backslashes, the
rest of a mark) gets one more backslash, which the parser takes away again. That map
has an inverse and leaves no mark in a text, so the second round always reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Fixed marks of the template.
OPEN, SAYS, ENDS, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
#: The role whose texts are learned from.
LEARNED = "assistant"
_RAW = r"([<\[])(\\*)(/?(?:s>|INST\]))"
_MARK = r"[<\[]/?(?:s>|INST\])"
_STUFFED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"


def escape(text) -> F.Column:
    return F.regexp_replace(text, _RAW, r"$1\\$2$3")


def unescape(text) -> F.Column:
    return F.regexp_replace(text, _STUFFED, "$1$2$3")


def conflicts(text) -> F.Column:
    """Whether the parser would not read a text back as it stands."""
    return text.rlike(_MARK) | (unescape(text) != text)


def safe(text) -> F.Column:
    """A text as it stands, and escaped where that does not read back."""
    return F.when(conflicts(text), escape(text)).otherwise(text)


def render(role, text) -> F.Column:
    """One turn."""
    return F.concat(F.lit(OPEN), safe(role), F.lit(SAYS), safe(text), F.lit(ENDS + CLOSE))


def parse(formatted) -> F.Column:
    """array<struct<role, text>> of a formatted conversation."""
    turns = F.filter(F.split(formatted, CLOSE), lambda t: t != "")

    def turn(t):
        body = F.substring(t, len(OPEN) + 1, F.length(t) - len(OPEN) - len(ENDS))
        at = F.locate(SAYS, body)
        return F.struct(unescape(F.substring(body, F.lit(1), at - 1)).alias("role"), unescape(F.substring(body, at + len(SAYS), F.length(body))).alias("text"))

    return F.transform(turns, turn)


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, formatted, turns, loss): turns is what the parser reads back, and equals the
    source, or the job fails; loss, the mask, is the spans of ``formatted`` that hold the
    assistant's texts, as (start, end) in characters and (from, upto) in bytes of UTF-8.

    Rows go by turn (null first), ties by role, then text; repeated rows are turns of
    their own. Null roles and texts are empty; a null conv_id is a conversation of its
    own. A conversation is one row, as its digest needs it in one piece. An empty table
    gives no rows; other columns are ignored."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    one = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), r.alias("role"), t.alias("text"))
    one = one.withColumn("shown", render(F.col("role"), F.col("text"))).withColumn("dated", F.col("turn").isNotNull()).withColumn("turn", F.coalesce("turn", F.lit(0)))
    before = Window.partitionBy("conv_id").orderBy("dated", "turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    one = one.withColumn("end", F.sum(F.length("shown")).over(before)).withColumn("upto", F.sum(F.octet_length("shown")).over(before))
    grouped = one.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("dated", "turn", "role", "text", "shown", "end", "upto"))).alias("t"))
    tail = len(ENDS + CLOSE)
    held = lambda x: safe(x["text"])
    span = lambda x: F.struct((x["end"] - tail - F.length(held(x))).alias("start"), (x["end"] - tail).alias("end"), (x["upto"] - tail - F.octet_length(held(x))).alias("from"), (x["upto"] - tail).alias("upto"))
    loss = F.transform(F.filter("t", lambda x: x["role"] == LEARNED), span)
    source = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    made = grouped.select("conv_id", F.array_join(F.transform("t", lambda x: x["shown"]), "").alias("formatted"), source.alias("source"), loss.alias("loss"))
    made = made.withColumn("turns", parse(F.col("formatted")))
    same = F.when(F.col("turns") == F.col("source"), F.col("turns")).otherwise(F.raise_error(F.lit("a conversation was not read back as it was")))
    return made.select("conv_id", "formatted", same.alias("turns"), "loss")


def digests(chats: DataFrame) -> DataFrame:
    """What a check needs of each conversation; the loss digest is of the text under the mask,
    cut from the formatted text and unescaped."""
    whole = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    data = F.col("formatted").cast("binary")
    under = F.transform("loss", lambda x: unescape(F.substring(data, (x["from"] + 1).cast("int"), (x["upto"] - x["from"]).cast("int")).cast("string")))
    loss = F.array_join(under, "")
    return chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
