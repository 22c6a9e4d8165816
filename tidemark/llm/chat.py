"""Chat formatting with Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_of

START, END, PART = "<|im_start|>", "<|im_end|>", "<|im_part|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Make the text free of ``<|`` in a way that :func:`unescape` takes back: ``~`` becomes ``~0``, ``<|`` becomes ``<~1``."""
    return F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<|"), F.lit("<~1"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<~1"), F.lit("<|")), F.lit("~0"), F.lit("~"))


def format_chat(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One formatted text per conversation, with the parts that carry loss.

    Takes ``conv_id, turn, role, text``; other columns are ignored. Turns are sorted by turn, then role and text, so ties
    and repeated rows have one order and all stay. Adjacent turns of one role form one message; a part mark between them
    keeps them apart. A NULL text or role is the empty text, a NULL turn sorts first, and rows without ``conv_id`` form a
    conversation of their own. An empty table gives no rows.

    Returns ``conv_id``, ``segments`` (structs of ``text`` and ``loss``, which put together are the formatted text) and
    ``formatted``. All array steps are linear in the number of turns.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        text_of().alias("text"),
    )
    collected = turns.select(F.col("conv_id"), turn.alias("t")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("t")).alias("turns")
    )
    # Each turn sees its neighbours by position: shifting the array of roles by one in both directions.
    roles = F.transform("turns", lambda t: t["role"])
    shifted = collected.select(
        "conv_id",
        F.arrays_zip(
            F.col("turns").alias("turn"),
            F.concat(F.array(F.lit(None).cast("string")), roles).alias("before"),
            F.concat(F.slice(roles, 2, F.size("turns")), F.array(F.lit(None).cast("string"))).alias("after"),
        ).alias("z"),
    )

    def head(role: Column) -> Column:
        return F.replace(escape(role), F.lit("\n"), F.lit("~2"))  # a header ends at the line's end

    def pieces(z: Column) -> Column:
        role = z["turn"]["role"]
        opens = F.when(z["before"].eqNullSafe(role), F.lit(PART)).otherwise(F.concat(F.lit(START), head(role), F.lit("\n")))
        closes = F.when(z["after"].eqNullSafe(role), F.lit("")).otherwise(F.concat(F.lit(END), F.lit("\n")))
        return F.array(
            F.struct(opens.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(z["turn"]["text"]).alias("text"), (role == loss_role).alias("loss")),
            F.struct(closes.alias("text"), F.lit(False).alias("loss")),
        )

    # The shifted array of earlier roles is one longer than the turns; the surplus entry has no turn.
    zipped = F.filter("z", lambda z: z["turn"].isNotNull())
    formed = shifted.select("conv_id", F.flatten(F.transform(zipped, pieces)).alias("segments"))
    return formed.select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_chat(formatted: Column) -> Column:
    """The turns of a formatted text, as structs of ``role`` and ``text``; the reverse of :func:`format_chat`."""

    def turns(message: Column) -> Column:
        head = F.substring_index(message, "\n", 1)
        role = unescape(F.replace(head, F.lit("~2"), F.lit("\n")))
        body = F.substring_index(message, END, 1)
        parts = F.split(body.substr(F.length(head) + 2, F.length(body)), _literal(PART), -1)
        return F.transform(parts, lambda p: F.struct(role.alias("role"), unescape(p).alias("text")))

    blocks = F.split(formatted, _literal(START), -1)
    messages = F.slice(blocks, F.lit(2), F.size(blocks))  # what stands before the first mark is empty
    return F.flatten(F.transform(messages, turns))


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return unescape(F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"]), ""))
