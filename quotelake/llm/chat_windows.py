"""Chat formatting: conversations as budgeted training windows of marked turns.

Template of a turn: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles a
backslash becomes ``\\s``, ``<|`` becomes ``<\\p`` and a line break of a role ``\\n``, so no
control string can come from a text, and ``unescape`` gives back what went in.

Windows. The prefix sum of turn sizes (words and a fixed overhead) cuts a conversation into
spans of whole turns. A span holds the turns that begin between two multiples of half the
room, the room being the budget less the system turn and the history limit, and a turn
above half the room is a span of its own. So every window is within the budget, but for a
turn or system turn that is itself too long for it: those stay whole. Each window has the
conversation's system turn, then the last turns of the span before within the history
limit, then its span. The loss mask has the span's assistant texts; repeated turns are
masked, so each assistant text is a target once.

Turns are ordered by turn, role and text, null first. Null texts and roles are empty; a null
conversation id is a conversation; repeated rows are turns of their own; an empty table gives
no windows; other columns are not read. Prefix sums run within blocks of turn numbers, so a
very long conversation is spread over tasks; windows are groups bounded by the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quotelake.llm.common import WORD, attach, prefix_sums, stage_table

START, END = "<|im_start|>", "<|im_end|>"
SYSTEM, TARGET = "system", "assistant"

BUDGET = 2048
HISTORY = 256
OVERHEAD = 4
LEAST_HALF = 64
TURNS_PER_BLOCK = 1024


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("<\\p"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\p"), F.lit("|")), F.lit("\\s"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def turn_size(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long") + OVERHEAD


def numbered(rows: DataFrame) -> DataFrame:
    """The turns with their size and the sum of sizes before them, which orders them."""
    turns = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / TURNS_PER_BLOCK).alias("part"),
    ).withColumn("size", turn_size(F.col("text")))
    summed = prefix_sums(turns, ["conv_id"], "part", ["turn", "role", "text"], "size", "before")
    return stage_table(summed.drop("turn", "part"), "turns")


def marked(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escape_role(role), F.lit("\n"), escape(text), F.lit(END + "\n"))


def _loss(turns: Column, lead: Column) -> Column:
    """Start and length of the target texts among the turns that follow ``lead`` characters."""
    begin = F.struct(lead.cast("long").alias("at"), F.expr("array()").cast("array<struct<start:long,length:long>>").alias("spans"))

    def step(done: Column, turn: Column) -> Column:
        span = F.struct((done["at"] + turn["head"]).alias("start"), turn["body"].alias("length"))
        return F.struct((done["at"] + F.length(turn["marked"])).alias("at"),
                        F.when(turn["target"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

    return F.aggregate(turns, begin, step)["spans"]


def windows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window_start (sum of sizes before its span, the order of
    windows), text, n_repeated (turns shown before its own), n_turns (its own), n_tokens
    (words and overhead, all turns), loss (start and length in ``text`` per target)."""
    turns = numbered(rows)
    systems = stage_table(turns.filter((F.col("before") == 0) & (F.col("role") == SYSTEM)).select(
        "conv_id", F.col("size").alias("system_size"), marked(F.col("role"), F.col("text")).alias("system")), "systems")

    half = F.greatest(F.lit(LEAST_HALF).cast("long"), F.floor(
        (budget - history - F.coalesce("system_size", F.lit(0))) / 2))
    spanned = attach(turns, systems.select("conv_id", "system_size"), ["conv_id"]).withColumn("half", half).withColumn(
        "span", 2 * F.floor(F.col("before") / F.col("half")) + (F.col("size") > F.col("half")).cast("long"))
    of_span = Window.partitionBy("conv_id", "span")
    spanned = (spanned.withColumn("first", F.min("before").over(of_span))
               .withColumn("end", F.max(F.col("before") + F.col("size")).over(of_span)))

    own = F.struct(F.col("first").alias("window_start"), F.lit(True).alias("own"))
    again = F.struct(F.col("end").alias("window_start"), F.lit(False).alias("own"))
    is_system = (F.col("before") == 0) & (F.col("role") == SYSTEM)
    repeated = (F.col("end") - F.col("before") <= history) & ~is_system
    shown = spanned.select("*", F.inline(F.when(repeated, F.array(own, again)).otherwise(F.array(own))))

    text = escape(F.col("text"))
    turn = F.struct("before", "own", "size", marked(F.col("role"), F.col("text")).alias("marked"),
                    (F.lit(len(START) + 1) + F.length(escape_role(F.col("role")))).cast("long").alias("head"),
                    F.length(text).cast("long").alias("body"),
                    (F.col("own") & (F.col("role") == TARGET) & (F.col("text") != "")).alias("target"))
    grouped = (shown.groupBy("conv_id", "window_start").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
               .withColumn("n_turns", F.size(F.filter("turns", lambda t: t["own"])))
               .filter("n_turns > 0"))  # no span begins where the last one ends
    lead = F.when(F.col("window_start") > 0, F.col("system"))
    return attach(grouped, systems, ["conv_id"]).select(
        "conv_id", "window_start",
        F.concat(F.coalesce(lead, F.lit("")),
                 F.array_join(F.transform("turns", lambda t: t["marked"]), "")).alias("text"),
        (F.size("turns") - F.col("n_turns") + lead.isNotNull().cast("int")).alias("n_repeated"),
        "n_turns",
        (F.aggregate("turns", F.lit(0).cast("long"), lambda s, t: s + t["size"])
         + F.when(lead.isNotNull(), F.col("system_size")).otherwise(0)).alias("n_tokens"),
        _loss(F.col("turns"), F.coalesce(F.length(lead), F.lit(0))).alias("loss"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """The windows' own turns and targets, parsed from their text: conv_id, window_start,
    turns (array of role and text), targets (array of texts)."""
    pieces = F.slice(F.split("text", r"<\|im_end\|>\n"), F.col("n_repeated") + 1, F.col("n_turns"))

    def parse(piece: Column) -> Column:
        rest = F.substr(piece, F.lit(len(START) + 1))
        role = F.substring_index(rest, "\n", 1)
        return F.struct(unescape_role(role).alias("role"),
                        unescape(F.substr(rest, F.length(role) + 2)).alias("text"))

    masked = F.transform("loss", lambda m: unescape(F.substr(F.col("text"), (m["start"] + 1).cast("int"), m["length"].cast("int"))))
    return formatted.select("conv_id", "window_start", F.transform(pieces, parse).alias("turns"), masked.alias("targets"),
                            F.length("text").cast("long").alias("chars"))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, from what ``read_turns`` gives: counts and digests of turns and targets."""
    flat = read_turns(formatted).select(
        "conv_id", F.size("turns").alias("n"), "chars", F.struct(
            "window_start",
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
            F.array_join("targets", "").alias("targets")).alias("part"))
    parts = flat.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list("part")).alias("parts"))
    turns = F.array_join(F.transform("parts", lambda p: p["turns"]), "")
    targets = F.array_join(F.transform("parts", lambda p: p["targets"]), "")
    return parts.select("conv_id", "n_turns", F.sha2(turns, 256).alias("turns_sha256"),
                        F.length(targets).cast("long").alias("loss_chars"),
                        F.sha2(targets, 256).alias("loss_sha256"), "formatted_chars")
