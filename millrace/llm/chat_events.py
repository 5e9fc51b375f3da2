"""Conversations rebuilt from their event logs and rendered for training.

A log row is an event of a turn: ``open`` starts the message with its role and first text, ``delta`` appends,
``edit`` replaces the text, ``regenerate`` empties the turn and drops what later turns said before it. Logs
are partitioned by conversation and sorted by sequence; windows find the last reset of every turn, and only
what follows is joined. One shuffle by conversation serves all steps. A rendered conversation is one row, so
it has to fit into one.

Defined results: a null text or role is empty; null sequences sort first, and at equal sequence open comes
before delta, edit and regenerate, then the smaller text; an event delivered twice counts once; events without
an ``open`` have an empty role; a null conversation id is a conversation of its own; unknown kinds are ignored;
columns beside the named ones are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import scan

START, END = "<|im_start|>", "<|im_end|>"
# Control strings of common templates, each as its first character and the rest.
CONTROL = r"(?=\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)"
KINDS = ("open", "delta", "edit", "regenerate")


def escape(text: Column) -> Column:
    """Put one more backslash behind the first character of every control string."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    """Undo :func:`escape`: take one backslash away."""
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, "$1$2")


def fold_events(events: DataFrame, conversation: str = "conv_id", turn: Sequence[str] = ("turn",)) -> DataFrame:
    """Final messages: one row per conversation and turn with ``role`` and ``text``.

    ``events`` has the named columns and ``seq, kind, role, text``.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.coalesce(F.col("kind"), F.lit("")))
    log = events.select(
        conversation, *turn, "seq", rank.cast("int").alias("rank"), "role", F.coalesce("text", F.lit("")).alias("text"),
    ).filter("rank > 0").repartition(conversation).dropDuplicates()
    so_far = Window.partitionBy(conversation).orderBy(*turn).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    of_turn = Window.partitionBy(conversation, *turn)
    cut = F.max(F.when(F.col("rank") == 4, F.col("seq"))).over(so_far)
    marked = log.withColumn("cut", cut)
    alive = F.coalesce(F.col("seq") >= F.col("cut"), F.col("cut").isNull())
    marked = marked.withColumn("alive", alive)
    reset = F.max(F.when(F.col("alive") & (F.col("rank") != 2), F.col("seq"))).over(of_turn)
    marked = marked.withColumn("reset", reset)
    counts = F.col("alive") & F.coalesce(
        (F.col("seq") > F.col("reset")) | ((F.col("seq") == F.col("reset")) & (F.col("rank") >= 1)), F.col("reset").isNull())
    pieces = F.sort_array(F.collect_list(F.when(counts, F.struct("seq", "rank", "text"))))
    opened = F.min(F.when((F.col("rank") == 1) & F.col("role").isNotNull(), F.struct("seq", "role")))
    return marked.groupBy(conversation, *turn).agg(
        pieces.alias("pieces"), opened.alias("opened"),
    ).filter(F.size("pieces") > 0).select(
        conversation, *turn, F.coalesce(F.col("opened.role"), F.lit("")).alias("role"),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("text"))


def render(messages: DataFrame, conversation: str = "conv_id", turn: Sequence[str] = ("turn",),
           learn_from: Sequence[str] = ("assistant",)) -> DataFrame:
    """One training text per conversation.

    New columns: ``formatted`` and ``turns``, an array of (start, text_start, text_end, end, loss) in code
    points of ``formatted``; text from text_start to text_end is learnt from where ``loss`` is true.
    """
    packed = messages.groupBy(conversation).agg(
        F.sort_array(F.collect_list(F.struct(*turn, "role", "text"))).alias("messages"))
    shown = packed.select(conversation, F.transform("messages", lambda m: F.struct(
        F.concat(F.lit(START), F.url_encode(m["role"]), F.lit("\n")).alias("head"), escape(m["text"]).alias("body"),
        m["role"].isin(*learn_from).alias("loss"))).alias("shown"))
    def step(acc: Column, x: Column) -> tuple[list[Column], Column]:
        text_start = acc["at"] + F.length(x["head"])
        text_end = text_start + F.length(x["body"])
        end = text_end + len(END) + 1
        return [end.alias("at")], F.struct(
            acc["at"].alias("start"), text_start.alias("text_start"), text_end.alias("text_end"), end.alias("end"), x["loss"].alias("loss"))

    return shown.select(
        conversation,
        F.array_join(F.transform("shown", lambda x: F.concat(x["head"], x["body"], F.lit(END + "\n"))), "").alias("formatted"),
        scan(F.col("shown"), {"at": F.lit(0)}, step, "struct<start:int,text_start:int,text_end:int,end:int,loss:boolean>").alias("turns"))


def read_back(rendered: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Messages and learnt texts of rendered conversations: ``messages`` (role, text) and ``learnt`` (texts)."""
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    cut = rendered.select(conversation, "formatted", F.zip_with(
        F.slice(pieces, F.lit(1), F.size("turns")), "turns", lambda p, t: F.struct(p.alias("piece"), t.alias("turn"))).alias("cut"))
    mask = F.filter("cut", lambda x: x["turn"]["loss"])
    return cut.select(
        conversation, "formatted",
        F.transform("cut", lambda x: F.struct(
            F.url_decode(F.substring_index(F.substr(x["piece"], F.lit(len(START) + 1)), "\n", 1)).alias("role"),
            unescape(F.substr(x["piece"], F.locate("\n", x["piece"]) + 1)).alias("text"))).alias("messages"),
        F.transform(mask, lambda x: unescape(F.substr(
            x["piece"], x["turn"]["text_start"] - x["turn"]["start"] + 1,
            x["turn"]["text_end"] - x["turn"]["text_start"]))).alias("learnt"))
