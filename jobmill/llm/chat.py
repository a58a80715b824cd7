"""Chat formatting with Spark expressions only.

A conversation is one string of blocks. A block opens with ``[ROLE name]``, holds the
texts of neighbouring turns with the same role, ``[AND]`` between two of them, and ends
with ``[END]``; the whole stands between ``<s>`` and ``</s>``. Control strings inside a
text get a ``~1`` after their first character, and a ``~`` becomes ``~0``, so no text can
forge a mark and every text can be had back. The marks of other common templates are
escaped as well, for trainers that look for them.

The result keeps the pieces of the string with their loss flag: only the texts of
``LEARNED`` roles are learned from, not their marks.

Defined cases: a null text is empty, a null role is an empty name; turns are ordered by
turn, then role and text, null first; repeated rows are turns of their own; rows with a
null conversation id make one conversation; an empty table gives an empty one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNED = ("assistant",)

START, STOP = "<s>", "</s>"
OPEN, SHUT = "[ROLE ", "]"
AND, END = "[AND]", "[END]"
#: Strings that a text may not hold as they are.
CONTROL = (
    START, STOP, OPEN, AND, END, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>",
)


def escape(text: Column) -> Column:
    """Text without control strings, from which ``unescape`` gives it back."""
    safe = F.replace(text, F.lit("~"), F.lit("~0"))
    return reduce(
        lambda x, mark: F.replace(x, F.lit(mark), F.lit(f"{mark[0]}~1{mark[1:]}")), CONTROL, safe
    )


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~1"), F.lit("")), F.lit("~0"), F.lit("~"))


def _role_name(role: Column) -> Column:
    """A role between the brackets of its mark: no bracket of its own."""
    return F.replace(escape(role), F.lit(SHUT), F.lit("~2"))


def _role(name: Column) -> Column:
    return unescape(F.replace(name, F.lit("~2"), F.lit(SHUT)))


def format_chats(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learned: tuple[str, ...] = LEARNED,
) -> DataFrame:
    """(conv_id, pieces, formatted): ``pieces`` are structs (text, loss) that make up
    ``formatted``."""
    turns = rows.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("entry"),
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("entry")).alias("turns"))
    entries = F.col("turns")

    def pieces(entry: Column, i: Column) -> Column:
        opens = (i == 0) | (F.get(entries, i - 1)["role"] != entry["role"])
        last = (i == F.size(entries) - 1) | (F.get(entries, i + 1)["role"] != entry["role"])
        head = F.when(i == 0, F.lit(START)).otherwise(F.lit(""))
        mark = F.when(opens, F.concat(F.lit(OPEN), _role_name(entry["role"]), F.lit(SHUT)))
        tail = F.when(last, F.lit(END)).otherwise(F.lit(""))
        stop = F.when(i == F.size(entries) - 1, F.lit(STOP)).otherwise(F.lit(""))
        return F.array(
            _piece(F.concat(head, mark.otherwise(F.lit(AND))), F.lit(False)),
            _piece(escape(entry["text"]), entry["role"].isin(*learned)),
            _piece(F.concat(tail, stop), F.lit(False)),
        )

    out = grouped.select("conv_id", F.flatten(F.transform(entries, pieces)).alias("pieces"))
    return out.select(
        "conv_id", "pieces", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted")
    )


def _piece(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as structs (role, text), with marks undone."""
    inner = F.substr(formatted, F.lit(len(START) + 1), F.length(formatted) - len(START) - len(STOP))
    blocks = F.filter(F.split(inner, r"\[END\]"), lambda x: F.length(x) > 0)

    def turns(block: Column) -> Column:
        name = F.substr(F.substring_index(block, SHUT, 1), F.lit(len(OPEN) + 1))
        texts = F.split(F.substr(block, F.locate(SHUT, block) + 1), r"\[AND\]")
        return F.transform(
            texts, lambda x: F.struct(_role(name).alias("role"), unescape(x).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def learned_text(pieces: Column) -> Column:
    """All text under the loss mask, in order, with marks undone."""
    texts = F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["text"]))
    return F.array_join(texts, "")
