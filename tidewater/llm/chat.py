"""Chat formatting with a grammar round trip, in SQL functions alone.

A turn is written ``<|im_start|>role<|im_sep|>text<|im_end|>``.  The parser is
deterministic: it splits at the end marks, wants one start mark and one
separator in every piece, and takes one backslash out of each ``<\\..\\|`` run.
Every turn is rendered plain, parsed again and compared with its source; a turn
that does not come back as it was is escaped (a backslash goes into each
``<|``, ``<\\|``, ...), after which no control string can stand in it and
parsing gives the source again.  The whole conversation is parsed once more
and ``round_trip`` says whether it came back identical.

The result holds the formatted text as segments with a loss flag (assistant
texts only); the segments joined are the text.

Null role or text is empty; turns come by (turn, role, text), a null turn
first; repeated rows stay; rows with a null conv_id form one conversation; an
empty table gives no conversations; other columns are not looked at.  A
conversation is one row of the result, so its turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column

# --- fixed values: the template -------------------------------------------
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# --- end fixed values -----------------------------------------------------
END_PATTERN, INNER_PATTERN = r"<\|im_end\|>", r"<\|im_start\|>|<\|im_sep\|>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", "<$1|")


def _piece(p: Column) -> Column:
    """(role, text) of what stands before an end mark; null if it isn't a turn."""
    parts = F.split(p, INNER_PATTERN, -1)
    well = p.startswith(START) & (F.size(parts) == 3) & (F.size(F.split(p, r"<\|im_sep\|>", -1)) == 2)
    return F.when(well, F.struct(unescape(F.get(parts, F.lit(1))).alias("role"), unescape(F.get(parts, F.lit(2))).alias("text")))


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted text."""
    pieces = F.split(formatted, END_PATTERN, -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), _piece)


def _rendered(t: Column, field: str) -> Column:
    return F.when(t["escaped"], escape(t[field])).otherwise(t[field])


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """Per conversation: conv_id, turns (source), segments (text, loss),
    formatted, recovered (turns parsed back), n_escaped, round_trip."""
    rows = turns.select(column(conv_col).alias("conv_id"), column(turn_col).alias("turn"),
                        F.coalesce(column(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))
    source = F.struct("role", "text")
    back = parse(F.concat(F.lit(START), "role", F.lit(SEP), "text", F.lit(END)))
    rows = rows.withColumn("escaped", ~F.coalesce((F.size(back) == 1) & (F.get(back, F.lit(0)) == source), F.lit(False)))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "escaped"))).alias("turns"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    convs = convs.withColumn("segments", F.flatten(F.transform("turns", lambda t: F.array(
        segment(F.concat(F.lit(START), _rendered(t, "role"), F.lit(SEP)), F.lit(False)),
        segment(_rendered(t, "text"), t["role"] == "assistant"),
        segment(F.lit(END), F.lit(False))))))
    convs = convs.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    convs = convs.withColumn("recovered", parse(F.col("formatted")))
    return convs.select(
        "conv_id", "turns", "segments", "formatted", "recovered",
        F.size(F.filter("turns", lambda t: t["escaped"])).alias("n_escaped"),
        (F.col("recovered") == F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))).alias("round_trip"))


def digest(convs: DataFrame) -> DataFrame:
    """Everything is read back from the formatted text and its mask."""
    told = F.array_join(F.transform("recovered", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return convs.select(
        "conv_id", F.size("recovered").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "round_trip")
