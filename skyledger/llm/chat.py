"""Conversations as one training text each, proved by reading the text back.

A turn is written as ``<s>role[INST] text [/INST]</s>``. A strict parser reads a rendered
conversation back: it ends turns at ``</s>`` and wants exactly one of each control string
in a turn, and it takes backslashes for escapes. If the turns it recovers are not those of
the source, the conversation is rendered anew with its roles and texts escaped: backslashes
are doubled, and a single backslash breaks up each control string. An escaped text holds
no control string, so the second reading always agrees; ``round_trip`` says so.

The loss mask is run-length coded over the code points of the formatted text: the text of
each assistant turn is under it, everything else is not.

Null roles and texts are empty; turns go by (turn, role, text), null turns first, so ties
and repeated rows keep a fixed order and each stays a turn of its own. No rows, no
conversations. A conversation is one text by nature: its turns meet in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROLS = r"<s>|</s>|\[INST\]|\[/INST\]"
OPEN, BODY, TAIL, CLOSE = "<s>", "[INST] ", " [/INST]", "</s>"
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, r"(<|\[)(/?(?:s>|INST\]))", r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def rendered(turns: Column, quote) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(OPEN), quote(t["role"]), F.lit(BODY), quote(t["text"]), F.lit(TAIL + CLOSE))), "")


def parsed(formatted: Column) -> Column:
    """The turns as written: role and text are still escaped, null where a turn is malformed."""

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(len(OPEN) + 1), F.length(piece))
        cut = F.locate(BODY, inner)
        sound = (
            (F.size(F.split(piece, CONTROLS, -1)) == 4) & piece.startswith(OPEN) & piece.endswith(TAIL) & (cut > 0)
        )
        body = F.substring(inner, cut + len(BODY), F.length(inner) - cut - len(BODY) + 1 - len(TAIL))
        return F.struct(F.when(sound, F.substring(inner, F.lit(1), cut - 1)).alias("role"), F.when(sound, body).alias("text"))

    pieces = F.split(formatted, CLOSE, -1)
    # Every turn ends with the closing mark, so what follows the last mark is no turn.
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def plain(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(unescaped(t["role"]).alias("role"), unescaped(t["text"]).alias("text")))


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, turns read back, mask, round_trip), one row for each conversation."""

    named = rows.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    whole = named.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("ordered"))
    source = whole.select("conv_id", F.transform("ordered", lambda t: F.struct(t["role"], t["text"])).alias("source"))
    first = source.withColumn("bare", rendered(F.col("source"), lambda text: text))
    agreed = first.withColumn("clean", plain(parsed(F.col("bare"))).eqNullSafe(F.col("source")))
    chosen = agreed.withColumn("formatted", F.when(F.col("clean"), F.col("bare")).otherwise(rendered(F.col("source"), escaped)))
    read = chosen.withColumn("written", parsed(F.col("formatted")))
    turns = read.withColumn("turns", plain(F.col("written")))

    def runs(t: Column) -> Column:
        head, tail = F.length(t["role"]) + len(OPEN + BODY), F.lit(len(TAIL + CLOSE))
        run = lambda chars, loss: F.struct(chars.alias("chars"), loss.alias("loss"))
        return F.array(run(head, F.lit(False)), run(F.length(t["text"]), unescaped(t["role"]) == LOSS_ROLE),
                       run(tail, F.lit(False)))

    return turns.select(
        "conv_id", "formatted", "turns", F.flatten(F.transform("written", runs)).alias("mask"),
        F.col("turns").eqNullSafe(F.col("source")).alias("round_trip"),
    )


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the mask, both read back from the formatted text."""

    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == LOSS_ROLE), lambda t: t["text"]), "")
    return formatted.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
    )
