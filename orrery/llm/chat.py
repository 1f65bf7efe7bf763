"""Chat formatting in budgeted windows (operator 1). DataFrame functions only.

Template: every turn is ``<s>[role]``, a newline, the text, ``</s>``. Control strings inside roles and texts
get a backslash after their first character (one more if there are some already), so markers never occur
in them and unescaping gives back the exact text.

Windows: a turn costs ``(bytes + 3) div 4 + 4`` tokens, or what a column says, such as a tokenizer's count. Prefix sums of the costs, taken in blocks of turns so
that a very long conversation is summed by many tasks, cut a conversation into turn-aligned spans: span k
has the turns that lie between k and k + 1 times the usable budget; a turn across the upper limit is a span
of its own. Every window starts with the leading system turn, then repeats up to ``history_turns``
earlier turns within ``history_tokens``, then has its span's turns. So it stays within ``budget`` but for a
single turn (or system turn) that alone exceeds it; no text is ever cut. Only the texts of assistant turns
in the span itself are under the loss mask: each once over all windows; repeated ones are masked.

Defined results: turns come in the order of turn (nulls first), role, text; repeated rows stay; null roles
and texts count as empty; rows with a null conversation id form one conversation. An empty table gives an empty one. Texts
have any length and are never cut; other columns aren't read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import written

OPEN, CLOSE = "<s>", "</s>"
#: ``<s> </s> [INST] [/INST]`` with any backslashes after the first character.
_CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
_ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"


@dataclass(frozen=True)
class Settings:
    budget: int = 2_048
    history_tokens: int = 256
    history_turns: int = 2
    block: int = 1_024  # turns that are summed in one group
    tokens: str | None = None  # a column with each turn's number of tokens; None, or a null in it: from its bytes


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    """As ``escape``, and without newlines."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    parts = F.split(unescape(role), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def token_cost(text: Column) -> Column:
    return F.floor((F.octet_length(text) + 3) / 4) + 4


def _span(start: Column, cost: Column, usable: Column) -> Column:
    k = F.floor(start / usable)
    return k * 2 + F.when(start + cost > (k + 1) * usable, 1).otherwise(0)


def _block(s: Settings) -> Column:
    """Turns that are summed together, in the order of turns; those without a number by role and the front of the text."""
    lone = F.col("turn").isNull()
    return F.struct(F.coalesce(F.floor(F.col("turn") / s.block), F.lit(-(1 << 60))).alias("turns"), F.when(lone, F.col("role")).otherwise("").alias("role"), F.when(lone, F.substring("text", 1, 2)).otherwise("").alias("front"))


def _placed(turns: DataFrame, s: Settings) -> DataFrame:
    """Every turn with its number ``i``, its offset, its span and, at the head of a span, the system turn."""
    order = ["turn", "role", "text"]
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), (F.col(f"`{s.tokens}`") if s.tokens else F.lit(None)).cast("long").alias("cost")
    )
    rows = rows.withColumn("cost", F.coalesce("cost", token_cost(F.col("text")))).withColumn("block", _block(s))
    rows = rows.withColumn("cid", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))  # joins by a value without nulls
    inside = Window.partitionBy("cid", "block").orderBy(*order)
    rows = rows.withColumns({
        "nth": F.row_number().over(inside) - 1,
        "upto": F.sum("cost").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        "last": F.lag("cost").over(inside),
    })
    place = F.struct(*order)
    blocks = rows.groupBy("cid", "block").agg(
        F.count("*").alias("n"), F.sum("cost").alias("sum"), F.min(F.struct("turn", "role", "text", "cost")).alias("first"), F.max_by("cost", place).alias("end")
    )
    across = Window.partitionBy("cid").orderBy("block")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    first = F.first("first").over(across.rowsBetween(Window.unboundedPreceding, 0))
    blocks = blocks.select(
        "cid", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("sum0"), F.lag("end").over(across).alias("end0"), F.when(first["role"] == "system", first).alias("sys")
    )
    rows = rows.join(blocks, ["cid", "block"])
    sys_cost = F.coalesce(F.col("sys.cost"), F.lit(0))
    i = F.col("n0") + F.col("nth")
    is_sys = (i == 0) & F.col("sys").isNotNull()
    start = F.when(is_sys, 0).otherwise(F.col("sum0") + F.col("upto") - F.col("cost") - sys_cost)
    usable = F.greatest(F.lit(s.budget - s.history_tokens) - sys_cost, F.lit(s.budget // 4))
    last = F.coalesce("last", "end0")
    rows = rows.select("cid", "conv_id", "role", "text", i.alias("i"), is_sys.alias("is_sys"), start.alias("start"), F.when(is_sys, 0).otherwise(F.col("cost")).alias("cost"), usable.alias("usable"), F.when((i == 1) & F.col("sys").isNotNull(), 0).otherwise(last).alias("last"), "sys")
    rows = rows.withColumn("span", _span(F.col("start"), F.col("cost"), F.col("usable")))
    head = (F.col("i") == 0) | (F.col("span") != _span(F.col("start") - F.col("last"), F.col("last"), F.col("usable")))
    return rows.withColumn("head", head).withColumn("sys", F.when(F.col("head") & ~F.col("is_sys"), F.col("sys"))).drop("usable", "last", "cost")


def format_windows(turns: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Windows ``conv_id, span, formatted, n_context, n_turns, loss_starts, loss_lengths`` of ``turns (conv_id, turn, role, text)``.

    ``n_context`` turns at the front are repeated from before; loss spans count code points from 0.
    """
    rows = written(_placed(turns, settings), "turns")
    own = rows.select("cid", "conv_id", "span", F.col("i").alias("at"), F.lit(True).alias("fresh"), "role", "text")
    system = rows.where("sys is not null").select("cid", "conv_id", "span", F.lit(-1).alias("at"), F.lit(False).alias("fresh"), F.col("sys.role").alias("role"), F.col("sys.text").alias("text"))
    heads = rows.where("head").select("cid", F.col("i").alias("h"), "span", F.col("start").alias("h_start"))
    past = rows.where("not is_sys").select("cid", "conv_id", "i", "start", "role", "text", F.explode(F.sequence(F.col("i") + 1, F.col("i") + settings.history_turns)).alias("h"))
    past = past.join(heads, ["cid", "h"]).where(F.col("h_start") - F.col("start") <= settings.history_tokens)
    past = past.select("cid", "conv_id", "span", F.col("i").alias("at"), F.lit(False).alias("fresh"), "role", "text")
    parts = own.unionByName(system).unionByName(past).groupBy("cid", "conv_id", "span").agg(F.array_sort(F.collect_list(F.struct("at", "fresh", "role", "text"))).alias("turns"))
    opened = F.transform("turns", lambda t: F.struct(F.concat(F.lit(OPEN + "["), escape_role(t["role"]), F.lit("]\n")).alias("open"), escape(t["text"]).alias("body"), (t["fresh"] & (t["role"] == "assistant")).alias("loss")))
    parts = parts.select("conv_id", "span", "turns", opened.alias("shown"))
    spans = F.aggregate(
        "shown",
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("starts"), F.expr("cast(array() as array<int>)").alias("lengths")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["open"]) + F.length(t["body"]) + len(CLOSE)).alias("at"),
            F.when(t["loss"], F.concat(acc["starts"], F.array(acc["at"] + F.length(t["open"])))).otherwise(acc["starts"]).alias("starts"),
            F.when(t["loss"], F.concat(acc["lengths"], F.array(F.length(t["body"])))).otherwise(acc["lengths"]).alias("lengths"),
        ),
    )
    return parts.select(
        "conv_id",
        "span",
        F.array_join(F.transform("shown", lambda t: F.concat(t["open"], t["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.size(F.filter("turns", lambda t: ~t["fresh"])).alias("n_context"),
        F.size("turns").alias("n_turns"),
        spans.alias("loss"),
    ).select("conv_id", "span", "formatted", "n_context", "n_turns", F.col("loss.starts").alias("loss_starts"), F.col("loss.lengths").alias("loss_lengths"))


def read_back(windows: DataFrame) -> DataFrame:
    """Per window the turns of its own span, parsed from ``formatted``, and the texts under the loss mask."""
    pieces = F.split("formatted", CLOSE)
    fresh = F.slice(pieces, F.col("n_context") + 1, F.size(pieces) - 1 - F.col("n_context"))
    cut = lambda p: F.instr(p, "\n")
    turns = F.transform(
        fresh,
        lambda p: F.struct(
            unescape_role(F.substring(p, F.lit(len(OPEN) + 2), cut(p) - len(OPEN) - 3)).alias("role"),
            unescape(F.substring(p, cut(p) + 1, F.length(p))).alias("text"),
        ),
    )
    loss = F.transform(F.arrays_zip("loss_starts", "loss_lengths"), lambda x: unescape(F.substring(F.col("formatted"), x["loss_starts"] + 1, x["loss_lengths"])))
    return windows.select("conv_id", "span", turns.alias("turns"), loss.alias("loss_texts"), F.length("formatted").cast("long").alias("chars"))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation the digests of its turns and of its loss texts, read back from the windows.

    A digest needs a conversation's whole text in one row; the windows themselves don't.
    """
    back = read_back(windows).select(
        "conv_id",
        "span",
        F.size("turns").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        F.array_join("loss_texts", "").alias("lost"),
        "chars",
    )
    whole = back.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("span", "said", "lost"))).alias("parts"), F.sum("chars").alias("formatted_chars"))
    said, lost = F.array_join("parts.said", ""), F.array_join("parts.lost", "")
    return whole.select(
        "conv_id",
        F.col("n_turns").cast("long"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(lost).cast("long").alias("loss_chars"),
        F.sha2(lost.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
