"""Chat formatting by DataFrame expressions alone, and reading the format back.

The turns of a conversation are collected as structs and sorted, neighbours of one role are merged
into a block by aggregating their slice of the array, and blocks are joined to one string:

    <|im_start|>role<|im_sep|>text<|im_next|>text<|im_end|><|im_start|>role<|im_sep|>...

``<|im_next|>`` stands between the turns of a block, so merged turns can be told apart again.  Control
strings inside texts and roles get a backslash after their first character, and backslashes are doubled,
so that a control string in the output is always one of the template's.  The loss mask is a list of
code point ranges, one per turn of the role to be learnt, that hold its escaped text and nothing else.

A formatted conversation is one value, so its turns meet in one task and must fit in a Spark value (2 GB).
With ``part_turns`` a longer conversation becomes several rows, each for a range of turn numbers: then
no row holds more than that many turn numbers, whatever one conversation has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

START, SEP, NEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_next|>", "<|im_end|>"
#: Strings of this template and of others that must not come out of a text as controls.
CONTROLS = (START, SEP, NEXT, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LEARNT = "assistant"
#: Elements that one running sum copies at a time.
RUN = 256


def escaped(text: Column) -> Column:
    """The text with no control string in it; ``unescaped`` gives it back."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}")), CONTROLS, doubled)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def sums_before(values: Column) -> Column:
    """For each element of a non-empty array of longs, the sum of those before it, in linear time."""
    zero = F.array(F.lit(0).cast("long"))

    def short(xs):  # one element longer than xs; the last is the total
        return F.aggregate(xs, zero, lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))

    last = F.floor((F.size(values) - 1) / RUN).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: short(F.slice(values, i * RUN + 1, RUN)))
    bases = short(F.transform(pieces, lambda p: F.element_at(p, -1)))
    shifted = F.transform(pieces, lambda p, i: F.transform(F.slice(p, 1, F.size(p) - 1), lambda v: v + F.get(bases, i)))
    return F.flatten(shifted)


def format_conversations(
    turns: DataFrame, part_turns: int | None = None, learnt: str = LEARNT,
    conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """(conv_id, part, formatted, loss): ``loss`` is an array of (start, end) code points, end exclusive.

    Rows go by turn, null turns first, then role, then text; rows that repeat one another all count.
    Null texts and null roles are empty strings; rows with a null id are one conversation.  ``part`` is 0
    unless ``part_turns`` cuts conversations by turn number.  Other columns are ignored, whatever they are
    called; an empty table gives an empty result.
    """
    part = F.lit(0).cast("long") if part_turns is None else F.coalesce(F.floor(F.col(f"`{turn}`") / part_turns), F.lit(0)).cast("long")
    of = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
    own = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"), part.alias("part"),
        F.struct(F.col(f"`{turn}`").alias("turn"), of(role).alias("role"), of(text).alias("text")).alias("t"),
    )
    rows = own.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    role_at = lambda i: F.get("ts", i)["role"]
    heads = F.filter(F.sequence(F.lit(0), F.size("ts") - 1), lambda i: (i == 0) | (role_at(i) != role_at(i - 1)))
    rows = rows.withColumn("heads", heads)
    until = lambda k: F.coalesce(F.get("heads", k + 1), F.size("ts"))
    blocks = F.transform("heads", lambda h, k: F.struct(
        role_at(h).alias("role"),
        F.transform(F.slice("ts", h + 1, until(k) - h), lambda t: escaped(t["text"])).alias("texts"),
    ))
    rows = rows.select("conv_id", "part", blocks.alias("blocks"))
    opened = lambda b: F.concat(F.lit(START), escaped(b["role"]), F.lit(SEP))
    whole = F.array_join(F.transform("blocks", lambda b: F.concat(opened(b), F.array_join(b["texts"], NEXT), F.lit(END))), "")
    # per turn: what stands before its text in its block, and its length with what closes the block
    lengths = F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda t, j: F.struct(
        F.when(j == 0, F.char_length(opened(b))).otherwise(len(NEXT)).cast("long").alias("lead"),
        F.char_length(t).cast("long").alias("size"),
        F.when(j == F.size(b["texts"]) - 1, len(END)).otherwise(0).cast("long").alias("tail"),
        (b["role"] == learnt).alias("on"),
    ))))
    rows = rows.select("conv_id", "part", whole.alias("formatted"), lengths.alias("ls"))
    rows = rows.withColumn("before", sums_before(F.transform("ls", lambda x: x["lead"] + x["size"] + x["tail"])))
    spans = F.transform("ls", lambda x, i: F.struct(
        (F.get("before", i) + x["lead"]).alias("start"), (F.get("before", i) + x["lead"] + x["size"]).alias("end"), x["on"].alias("on")))
    loss = F.transform(F.filter(spans, lambda s: s["on"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return rows.select("conv_id", "part", "formatted", loss.alias("loss"))


def turns_of(formatted: Column) -> Column:
    """Array of (role, text) read from a formatted string."""
    literal = lambda s: "\\Q" + s + "\\E"
    blocks = F.filter(F.split(formatted, literal(START)), lambda b: b != "")
    parts = F.transform(blocks, lambda b: F.split(F.substr(b, F.lit(1), F.char_length(b) - len(END)), literal(SEP)))
    return F.flatten(F.transform(parts, lambda p: F.transform(
        F.split(F.get(p, F.lit(1)), literal(NEXT)),
        lambda t: F.struct(unescaped(F.get(p, F.lit(0))).alias("role"), unescaped(t).alias("text")))))


def masked_text(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped, piece after piece."""
    cut = lambda s: F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
    return F.array_join(F.transform(loss, lambda s: unescaped(cut(s))), "")


def digests(formatted: DataFrame) -> DataFrame:
    """One row per formatted row, all read back from its string and its mask."""
    read = formatted.select("conv_id", F.char_length("formatted").cast("long").alias("formatted_chars"),
                            turns_of(F.col("formatted")).alias("turns"), masked_text(F.col("formatted"), F.col("loss")).alias("masked"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"), "formatted_chars",
    )
