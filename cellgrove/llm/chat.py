"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: all turns before it are its context, the reply alone is
trainable. A conversation that does not end in an assistant turn gives one more example without a
target, so no turn is lost. A turn is written as

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Control strings inside roles and texts are escaped reversibly: a backslash is doubled, ``<|`` becomes
``<\\|``, and a line feed in a role becomes ``\\n``; so ``<|`` in an example always starts a marker.

Turns are gathered once per conversation (one shuffle of the rows); the expansion, which grows with the
square of a conversation's turns by its nature, is streamed from there and never shuffled again.

Defined results: null role or text is empty; turns are ordered by turn (nulls first), equal turns by
role and text, repeated rows are all kept; an empty table gives no examples; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if role else out


def unescape(text: Column, role: bool = False) -> Column:
    """Reads escapes from left to right; most texts have none."""
    plain = F.regexp_replace(F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)\\n", "$1\n") if role else text, r"\\([\\|])", "$1")
    return F.when(F.contains(text, F.lit("\\")), plain).otherwise(text)


def _turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def expand(turns: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Examples: conversation, example (0, 1, ...), n_context (turns before the target), has_target,
    is_last, text, loss_start and loss_length (code points of ``text``; the one trainable span)."""
    rows = turns.select(
        F.col(conversation).alias("__conv"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("__row"),
    )
    whole = rows.groupBy("__conv").agg(F.sort_array(F.collect_list("__row")).alias("__rows"))
    whole = whole.select("__conv", F.transform("__rows", lambda r: F.struct((r.role == ASSISTANT).alias("target"), escape(r.role, role=True).alias("role"), escape(r.text).alias("text"))).alias("__rows"))
    n = F.size("__rows")
    targets = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.col("__rows")[i].target)
    ends = F.when(F.element_at("__rows", -1).target, targets).otherwise(F.concat(targets, F.array(n)))
    each = whole.select("__conv", "__rows", F.posexplode(ends).alias("__example", "__at"))
    # slice() hands out turns by reference: a context is joined once, for its own example
    context = F.array_join(F.transform(F.slice("__rows", F.lit(1), F.col("__at")), lambda r: _turn(r.role, r.text)), "")
    has = F.col("__at") < F.size("__rows")
    head = F.concat(context, F.when(has, F.lit(f"{START}{ASSISTANT}\n")).otherwise(F.lit("")))
    reply = F.when(has, F.col("__rows")[F.col("__at")].text).otherwise(F.lit(""))
    each = each.select("__conv", "__example", F.col("__at").cast("long").alias("__at"), has.alias("__has"), (F.col("__at") >= F.size("__rows") - 1).alias("__last"), head.alias("__head"), reply.alias("__reply"))
    return each.select(
        F.col("__conv").alias(conversation),
        F.col("__example").cast("long").alias("example"),
        F.col("__at").alias("n_context"),
        F.col("__has").alias("has_target"),
        F.col("__last").alias("is_last"),
        F.concat("__head", "__reply", F.when(F.col("__has"), F.lit(END + "\n")).otherwise(F.lit(""))).alias("text"),
        F.char_length("__head").cast("long").alias("loss_start"),
        F.char_length("__reply").cast("long").alias("loss_length"),
    )


def parse(text: Column) -> Column:
    """The turns of a formatted example: array of (role, text), unescaped."""
    bodies = F.slice(F.split(text, r"<\|im_start\|>", -1), 2, F.greatest(F.lit(1), F.size(F.split(text, r"<\|im_start\|>", -1))))
    return F.transform(
        bodies,
        lambda b: F.struct(
            unescape(F.substring_index(b, "\n", 1), role=True).alias("role"),
            unescape(F.substr(b, F.instr(b, F.lit("\n")) + 1, F.char_length(b) - F.instr(b, F.lit("\n")) - F.lit(len(END) + 1))).alias("text"),
        ),
    )


def loss_text(text: Column, start: Column, length: Column) -> Column:
    """What the loss mask covers, unescaped."""
    return unescape(F.substr(text, (start + 1).cast("int"), length.cast("int")))


def read_back(examples: DataFrame, *, conversation: str = "conv_id") -> DataFrame:
    """Per conversation, from the formatted examples alone: n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars (code points of all its examples), n_examples. Groups by the key the
    examples are already partitioned on, so nothing is shuffled."""
    full = F.when(F.col("is_last"), F.col("text"))
    read = examples.select(
        conversation,
        F.when(F.col("has_target"), F.struct("example", loss_text(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("reply"))).alias("__reply"),
        F.char_length("text").cast("long").alias("__chars"),
        F.size(F.when(F.col("is_last"), parse(F.col("text")))).alias("__turns"),
        F.when(F.col("is_last"), F.sha2(F.array_join(F.transform(parse(full), lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""), 256)).alias("__sha"),
    )
    out = read.groupBy(conversation).agg(
        F.max("__turns").cast("long").alias("n_turns"),
        F.max("__sha").alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list("__reply")), lambda r: r.reply), "").alias("__loss"),
        F.sum("__chars").alias("formatted_chars"),
        F.count("*").alias("n_examples"),
    )
    return out.select(conversation, "n_turns", "turns_sha256", F.char_length("__loss").cast("long").alias("loss_chars"), F.sha2("__loss", 256).alias("loss_sha256"), "formatted_chars", "n_examples")
