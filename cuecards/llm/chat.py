"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs, sorted, neighbours of one role
merged, and concatenated:

    [INST] question [+] more of it [/INST][OUT] answer </s>

Each block opens with its role's tag and ends with its closing tag; turns that
were merged are separated by ``[+]``.  A control string inside a text gets a
backslash after its first character (one that has backslashes there gets one
more), so control strings in the output are the template's own and the texts
can be restored exactly.  Roles without a tag of their own use ``[ROLE name]``.

The mask of a formatted conversation lists the code point ranges of the texts
of one role (escapes included), one range per turn.

Whether a turn begins or ends a block follows from its neighbours' roles, and
positions are prefix sums, so a conversation of n turns is one pass over its
array (prefix sums: about n ** 1.5 steps); no array is copied turn by turn.

Defined results: a null text is empty, a null role is the empty name, null
turns sort first, ties are ordered by role and text, a null conversation id is
a conversation of its own, an empty table gives no rows, extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuecards.llm.expressions import let, prefix_sums

# The template.
OPEN = {"system": "[SYS] ", "user": "[INST] ", "assistant": "[OUT] "}
CLOSE = {"system": " [/SYS]", "user": " [/INST]", "assistant": " </s>"}
OTHER_CLOSE = " [/ROLE]"
JOIN = " [+] "

# What follows the first character of a control string; the name of another role runs up to the bracket.
_TAIL = r"(/?SYS\]|/?INST\]|OUT\]|\+\]|/?ROLE[ \]]|/s>)"
_ESCAPE = r"([\[<])(\\*)" + _TAIL
_UNESCAPE = r"([\[<])\\(\\*)" + _TAIL
_BLOCK = r"(?s)\[(?:SYS|INST|OUT|ROLE [^\]]*)\] .*?(?: \[/SYS\]| \[/INST\]| </s>| \[/ROLE\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


def _escape_role(role: Column) -> Column:
    """A role name inside its tag: no bracket may stand there."""
    return F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("]"), F.lit("%5D"))


def _unescape_role(name: Column) -> Column:
    return F.replace(F.replace(name, F.lit("%5D"), F.lit("]")), F.lit("%25"), F.lit("%"))


def _by_role(role: Column, known: dict[str, str], other: Column) -> Column:
    out = None
    for name, tag in known.items():
        out = F.when(role == name, tag) if out is None else out.when(role == name, tag)
    return out.otherwise(other)


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv, formatted``."""
    src = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                       F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    gathered = src.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    turns_ = F.col("turns")

    def piece(t: Column, i: Column) -> Column:
        role = t["role"]
        opens = F.coalesce(F.get(turns_, i - 1)["role"] != role, F.lit(True))
        closes = F.coalesce(F.get(turns_, i + 1)["role"] != role, F.lit(True))
        return F.concat(F.when(opens, _by_role(role, OPEN, F.concat(F.lit("[ROLE "), _escape_role(role), F.lit("] ")))).otherwise(JOIN),
                        escape(t["text"]), F.when(closes, _by_role(role, CLOSE, F.lit(OTHER_CLOSE))).otherwise(""))

    return gathered.select("conv", F.array_join(F.transform(turns_, piece), "").alias("formatted"))


def read_chats(chats: DataFrame) -> DataFrame:
    """``conv, formatted, turns``: the turns (role, text) restored from the
    formatted text alone."""
    names = {tag[1:-2]: role for role, tag in OPEN.items()}

    def parts(block: Column) -> Column:
        tag = F.substring_index(block, "] ", 1)
        inside = F.substr(tag, F.lit(2))
        role = None
        for name, r in names.items():
            role = F.when(inside == name, r) if role is None else role.when(inside == name, r)
        role = role.otherwise(_unescape_role(F.substr(inside, F.lit(6))))
        close = F.regexp_extract(block, r"( \[/SYS\]| \[/INST\]| </s>| \[/ROLE\])$", 1)
        start = F.char_length(tag) + 3
        body = F.substr(block, start, F.char_length(block) - F.char_length(close) - start + 1)
        return F.transform(F.split(body, r" \[\+\] ", -1),
                           lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    blocks = F.regexp_extract_all("formatted", F.lit(_BLOCK), F.lit(0))
    return chats.select("conv", "formatted", F.flatten(F.transform(blocks, parts)).alias("turns"))


def loss_mask(formatted: Column, role: str = "assistant") -> Column:
    """Code point ranges (start, end) of the texts of ``role`` in a formatted
    conversation, one per turn, tags and separators left out."""
    open_len, close_len = len(OPEN[role]), len(CLOSE[role])
    spans = "array<struct<start: int, end: int>>"

    def inner(block: Column, at: Column) -> Column:
        """Ranges of one block's turns; the block starts at ``at``."""
        body = F.substr(block, F.lit(open_len + 1), F.char_length(block) - (open_len + close_len))
        sizes = F.transform(F.split(body, r" \[\+\] ", -1), F.char_length)
        return let(sizes, lambda n: let(prefix_sums(F.transform(n, lambda x: x + len(JOIN))), lambda p: F.transform(
            n, lambda x, j: F.struct((at + open_len + F.get(p, j)).alias("start"), (at + open_len + F.get(p, j) + x).alias("end")))))

    def ranges(blocks: Column) -> Column:
        return let(prefix_sums(F.transform(blocks, F.char_length)), lambda at: F.flatten(F.transform(
            blocks, lambda b, i: F.when(F.startswith(b, F.lit(OPEN[role])), inner(b, F.get(at, i))).otherwise(F.array().cast(spans)))))

    return let(F.regexp_extract_all(formatted, F.lit(_BLOCK), F.lit(0)), ranges)


def masked_text(formatted: Column, mask: Column) -> Column:
    """The unescaped text under a mask, ranges in order, nothing between.
    Many ranges are cut from the array of characters, where a range's place
    costs nothing; a few are cut from the text."""
    def few(s: Column) -> Column:
        return F.substr(formatted, s["start"] + 1, s["end"] - s["start"])

    many = let(F.split(formatted, ""), lambda chars: F.array_join(F.transform(
        mask, lambda s: unescape(F.array_join(F.slice(chars, s["start"] + 1, s["end"] - s["start"]), ""))), ""))
    return F.when(F.size(mask) <= 64, F.array_join(F.transform(mask, lambda s: unescape(few(s))), "")).otherwise(many)
