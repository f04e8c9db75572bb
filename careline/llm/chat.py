"""Chat formatting with Spark expressions: one text for each conversation, with a loss mask, and back again.

A conversation is a chain of blocks, one for each run of turns of one role:

    <|im_start|>role\\ntext[<|im_next|>text ...]<|im_end|>\\n

In texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no text can hold a mark; in roles
``%``, ``<`` and line breaks are written like ``%3C``.  Both are undone when the text is read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careline.llm.common import let

START, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>\n"


def _replaced(value: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        value = F.replace(value, F.lit(old), F.lit(new))
    return value


def escape(text: Column) -> Column:
    return _replaced(text, ("\\", "\\\\"), ("<|", "<\\|"))


def unescape(text: Column) -> Column:
    return _replaced(text, ("<\\|", "<|"), ("\\\\", "\\"))


def escape_role(role: Column) -> Column:
    return _replaced(role, ("%", "%25"), ("<", "%3C"), ("\n", "%0A"))


def unescape_role(role: Column) -> Column:
    return _replaced(role, ("%0A", "\n"), ("%3C", "<"), ("%25", "%"))


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", learn: str = "assistant") -> DataFrame:
    """A row for each conversation: ``conv``, ``formatted`` and ``segments``.

    ``segments`` holds the same text in parts, marks and turns' texts by turns, each with ``loss``:
    true for the texts of the role ``learn``, which are what a model is to learn, and false for
    everything else.  Turns are sorted by number, then role, then text (ties and repeated rows thus
    have one order; a null number comes first), and adjacent turns of one role share a block.  Null
    texts and roles count as empty, rows with a null conversation make up one conversation, other
    columns are left out.  No turns: no row.

    One shuffle by conversation; sorting, merging and joining run inside the row and take time in
    proportion to its length.  A conversation is one text, so it has to fit into one.
    """
    turn_row = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    sorted_turns = turns.groupBy(F.col(conv)).agg(F.sort_array(F.collect_list(turn_row)).alias("__turns"))

    def parts(ts: Column) -> Column:
        def of(t: Column, i: Column) -> Column:
            begin = F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))
            mark = (F.when(i == 0, begin).when(F.get(ts, i - 1)["role"] == t["role"], F.lit(NEXT))
                    .otherwise(F.concat(F.lit(END), begin)))
            return F.array(_segment(mark, F.lit(False)), _segment(escape(t["text"]), t["role"] == learn))

        return F.concat(F.flatten(F.transform(ts, of)), F.array(_segment(F.lit(END), F.lit(False))))

    segments = sorted_turns.select(conv, let(F.col("__turns"), parts).alias("segments"))
    return segments.select(conv, "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: array<struct<role, text>>."""
    blocks = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 2**30)

    def turns_of(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        begin = F.char_length(role) + 2
        body = F.substring(block, begin, F.char_length(block) - begin + 1 - len(END))
        return F.transform(F.split(body, r"<\|im_next\|>"), lambda t: F.struct(
            unescape_role(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
