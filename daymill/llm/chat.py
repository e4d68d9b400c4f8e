"""Chat formatting by prefix-target expansion, on DataFrame functions only.

Every assistant turn becomes an example: all turns before it are its context, its own reply is
the one part under the loss mask. ``expand`` renders one piece per turn and places the replies;
``write_examples`` writes every example out whole, context and reply, with the character range of
the reply, and the turns after a conversation's last reply once, without a mask. What ``digest``
tells is read back from those texts. Written out, contexts repeat, so characters grow with the
square of a conversation's length; a conversation of much text is therefore dealt in shares of its
examples, and a task forms one example at a time.

A piece is ``<|turn|>`` role ``<|text|>`` text ``<|end|>``. Inside roles and texts a backslash is
doubled and ``<|`` becomes ``<\\|``, so no mark can be forged and every text comes back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymill.llm.common import stage

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
_END = r"<\|end\|>"
_HEADS = r"<\|(?:turn|text)\|>"
#: Characters of a conversation's examples from which they are dealt among tasks.
SHARE_CHARS = 64_000_000


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    bare = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    return F.replace(bare, F.lit("\\\\"), F.lit("\\"))


def expand(turns: DataFrame) -> DataFrame:
    """Rendered turns of conversations (conv_id, turn, role, text), assistant turns as examples.

    Returns conv_id, position (from 0), piece, prefix_chars (characters of all pieces before),
    example (number of the reply from 0, null for other roles), loss_start and loss_end (range
    of the reply in the example's text, null for other roles). The example's text is every
    piece of the conversation up to its own.

    A null text or role counts as empty. Turns are ordered by turn, then role, then text, nulls
    first, so repeated turns each keep their place. Rows without conv_id form one conversation.
    Further columns are not carried. An empty table gives an empty one.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    reply = F.col("role") == "assistant"
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    body = escape(F.col("text"))
    rendered = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).select("*", F.length(head).cast("long").alias("head_chars"), F.length(body).cast("long").alias("body_chars"), F.concat(head, body, F.lit(END)).alias("piece"))
    start = F.col("prefix_chars") + F.col("head_chars")
    return rendered.select(
        "conv_id",
        (F.row_number().over(order) - 1).alias("position"),
        "piece",
        F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)).alias("prefix_chars"),
        F.when(reply, F.coalesce(F.sum(reply.cast("long")).over(before), F.lit(0))).alias("example"),
        "head_chars",
        "body_chars",
    ).select(
        "conv_id",
        "position",
        "piece",
        "prefix_chars",
        "example",
        F.when(F.col("example").isNotNull(), start).alias("loss_start"),
        F.when(F.col("example").isNotNull(), start + F.col("body_chars")).alias("loss_end"),
    )


def _formed(pieces: DataFrame) -> DataFrame:
    """conv_id, example, text, loss_start, loss_end, final: every example, and the turns after the last reply.

    Those turns have no example number and no mask. ``final`` marks the last example and them: joined, these two
    texts are the conversation.
    """
    at = F.col("position").cast("int")
    reply = F.col("example").isNotNull()
    whole = F.col("prefix_chars") + F.length("piece")
    packed = pieces.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct(at.alias("position"), "piece"))).alias("turns"),
        F.array_sort(F.collect_list(F.when(reply, F.struct("example", "loss_start", "loss_end", at.alias("last"))))).alias("replies"),
        F.ceil(F.coalesce(F.sum(F.when(reply, whole)), F.lit(0)) / SHARE_CHARS).alias("shares"),
    )
    shares = F.greatest("shares", F.lit(1))
    dealt = packed.select(
        "conv_id",
        F.transform("turns", lambda t: t.piece).alias("pieces"),
        "replies",
        shares.alias("shares"),
        F.explode(F.sequence(F.lit(0).cast("long"), shares - 1)).alias("share"),
    ).repartition("conv_id", "share")
    n, replied = F.size("pieces"), F.size("replies")
    after = F.when(replied > 0, F.get("replies", replied - 1).last + 1).otherwise(0)

    def row(first, last, example, start, end, final):
        kinds = {"first": "int", "last": "int", "example": "long", "loss_start": "long", "loss_end": "long", "final": "boolean"}
        return F.struct(*(c.cast(kind).alias(name) for (name, kind), c in zip(kinds.items(), (first, last, example, start, end, final), strict=True)))

    own = F.filter("replies", lambda r: F.pmod(r.example, F.col("shares")) == F.col("share"))
    none = F.lit(None)
    targets = F.concat(
        F.transform(own, lambda r: row(F.lit(0), r.last, r.example, r.loss_start, r.loss_end, r.example == replied - 1)),
        F.filter(F.array(row(after, n - 1, none, none, none, F.lit(True))), lambda r: (r.first < n) & (F.col("share") == 0)),
    )
    text = F.array_join(F.slice("pieces", F.col("first") + 1, F.col("last") - F.col("first") + 1), "")
    return dealt.select("conv_id", "pieces", F.inline(targets)).select("conv_id", "example", text.alias("text"), "loss_start", "loss_end", "final")


def examples(pieces: DataFrame) -> DataFrame:
    """Whole examples: conv_id, example, text, loss_start, loss_end."""
    return _formed(pieces).filter("example IS NOT NULL").drop("final")


def write_examples(pieces: DataFrame) -> DataFrame:
    """All examples as written out, and the turns after each last reply; see ``_formed`` for the columns."""
    return stage(_formed(pieces), "chat-examples")


def read_back(written: DataFrame) -> DataFrame:
    """Each written text taken apart: conv_id, example, chars, reply (the text under the loss mask), turns.

    Turns (role and text each) are those of the final texts only; other examples are beginnings of them.
    """
    masked = F.substring(F.col("text"), (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    pieces = F.filter(F.split("text", _END), lambda p: p != "")

    def turn(piece: Column) -> Column:
        parts = F.split(piece, _HEADS)
        return F.struct(unescape(parts[1]).alias("role"), unescape(parts[2]).alias("text"))

    return written.select(
        "conv_id",
        "example",
        F.length("text").cast("long").alias("chars"),
        F.when(F.col("example").isNotNull(), unescape(masked)).alias("reply"),
        F.when(F.col("final"), F.transform(pieces, turn)).alias("turns"),
    )


def digest(pieces: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples as written: turns, loss text and characters.

    formatted_chars adds up the texts of all examples, and the turns after the last reply once.
    """
    number = F.coalesce("example", F.lit(2**62))  # turns after the last reply come last
    texts = F.array_sort(F.collect_list(F.struct(number.alias("number"), "reply", "turns")))
    return (
        read_back(write_examples(pieces))
        .groupBy("conv_id")
        .agg(texts.alias("texts"), F.sum("chars").alias("formatted_chars"), F.count("example").alias("n_examples"))
        .select(
            "conv_id",
            F.flatten(F.filter(F.transform("texts", lambda t: t.turns), lambda t: t.isNotNull())).alias("turns"),
            F.array_join(F.transform("texts", lambda t: t.reply), "").alias("loss"),
            "formatted_chars",
            (F.col("n_examples") > 0).alias("trainable"),
        )
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            "formatted_chars",
            "trainable",
        )
    )
