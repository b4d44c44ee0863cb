"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted by (turn, role, text). Adjacent turns of one
role are merged into one block, which keeps their texts apart:

    ### role:
    first text
    <next>
    second text
    </turn>

In texts and roles a backslash stands before each backslash, # and <, in roles also before : and a line
break. So an unescaped mark is never part of a text, and `read_back` returns the very turns. `mask` holds the
spans (start, end; code points) of the assistant's texts in the formatted text: what a loss is taken on.

A null text or role is empty; a null turn comes first. Rows that repeat are turns of their own. A
conversation's turns and text are one row, as its result is. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gableboard.llm.tables import running

HEAD, COLON, NEXT, CLOSE = "### ", ":\n", "\n<next>\n", "\n</turn>\n"
MASKED = "assistant"


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\#<])", r"\\$1")


def escaped_role(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\#<:\n])", r"\\$1")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def formatted(turns: DataFrame, masked: str = MASKED) -> DataFrame:
    """conv_id, formatted, mask (array of start, end) of every conversation; turns: conv_id, turn, role, text."""
    empty = F.lit("")
    row = F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    collected = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))

    def piece(t, i):
        other = lambda k: ~F.get("turns", k)["role"].eqNullSafe(t["role"])
        return F.struct(
            F.when(other(i - 1), F.concat(F.lit(HEAD), escaped_role(t["role"]), F.lit(COLON))).otherwise(NEXT).alias("lead"),
            escaped(t["text"]).alias("text"), F.when(other(i + 1), F.lit(CLOSE)).otherwise("").alias("tail"),
            (t["role"] == masked).alias("masked"))

    pieces = collected.select("conv_id", F.transform("turns", piece).alias("pieces"))

    def step(at, p):
        start = at + F.length(p["lead"])
        end = start + F.length(p["text"])
        return end + F.length(p["tail"]), F.when(p["masked"], F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end")))

    spans = running(F.col("pieces"), "struct<start:bigint,end:bigint>", step)
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["lead"], p["text"], p["tail"])), "")
    return pieces.select("conv_id", text.alias("formatted"), spans.alias("mask"))


def read_back(text: Column) -> Column:
    """The turns (array of role, text) of a formatted text."""
    blocks = F.split(text, CLOSE, -1)
    role = lambda b: unescaped(F.regexp_extract(b, r"(?s)^### ((?:[^\\:]++|\\.)*+):\n", 1))
    body = lambda b: F.regexp_replace(b, r"(?s)^### (?:[^\\:]++|\\.)*+:\n", "")
    return F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), lambda b: F.transform(
        F.split(body(b), NEXT, -1), lambda t: F.struct(role(b).alias("role"), unescaped(t).alias("text")))))


def under_mask(text: Column, mask: Column) -> Column:
    """The unescaped text under the mask."""
    return F.array_join(F.transform(mask, lambda m: unescaped(F.substring(
        text, (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")))), "")
