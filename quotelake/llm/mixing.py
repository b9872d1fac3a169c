"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents are put in a hashed order; their words form one stream, which is
cut into blocks of equal size. The points of the golden-ratio sequence fall into the
sources' shares of the target, which makes the schedule of slots; the k-th slot of a source
takes its k-th block, starting again at the first block when the stream ends. A source's
last slot is cut so that it gives exactly its target, rounded down.

Sources, documents, blocks and slots are tables; the driver sees sums only. Sums over documents
run within (source, part of the hashed order), so a hot source is spread. Points find their source
by the cells of the unit interval that its share covers; points are uniform, so cells are even
however uneven the shares. A null source is a source and the last one; null and empty texts
have size 0 and are never taken; repeated rows count each; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from quotelake.llm.common import (BROADCAST_BYTES, WORD, attach, null_marked, prefix_sums, shuffle_key, stage_table,
                                  table_bytes, words)

WEIGHTS = (5, 2, 1)
SHARE = 1.5        # of all words
MOST = 2           # times a source's words
BLOCK_WORDS = 1024
ROWS_PER_BUCKET = 5_000
GOLDEN = (math.sqrt(5) - 1) / 2
CHUNK = 1 << 16
SOURCES_PER_RANGE = 4096


def fill(sources: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Add ``target`` to a staged table of ``source_size`` and ``weight``: shares of the whole by
    weight; what a source cannot take goes to the others by weight.

    Each round finds the words per weight at which the open sources take what the full ones
    leave, which fills more sources; the driver sees two sums a round.
    """
    limit = F.lit(most) * F.col("source_size")
    whole = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, full, open_weight = 0.0, F.lit(False), math.inf
    while True:
        row = sources.agg(F.sum(F.when(full, limit)).alias("taken"), F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if not row["weight"] or row["weight"] >= open_weight:
            break
        open_weight = row["weight"]
        level = (whole - (row["taken"] or 0)) / open_weight
        full = limit <= F.lit(level) * F.col("weight")
    target = F.when(full, limit.cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return sources.withColumn("target", F.round(target, 6))


def golden_points(i: Column) -> Column:
    """Fraction of i times the golden ratio, exact enough up to 2^40 points."""
    step = (GOLDEN * (1 << 20)) % 1.0
    x = F.floor(i / F.lit(1 << 20)) * F.lit(step) + (i % F.lit(1 << 20)) * F.lit(GOLDEN)
    return x - F.floor(x)


def row_key() -> tuple[Column, Column]:
    """128 bits that equal rows share."""
    return (F.xxhash64(*null_marked("doc_id", "source", "text")).alias("key_a"),
            F.xxhash64(*null_marked("text", "source", "doc_id")).alias("key_b"))


def sized(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, source, size in words, the hashed order and a row key of every document."""
    return docs.select(
        "doc_id", "source", *row_key(),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        shuffle_key(F.lit(seed), F.col("doc_id")).alias("order_key"))


def source_targets(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source in code point order: source_no, source, source_size, target."""
    last = F.col("source").asc_nulls_last()
    ranged = stage_table(
        documents.groupBy("source").agg(F.sum("size").alias("source_size")).repartitionByRange(last)
        .withColumns({"range": F.spark_partition_id(), "one": F.lit(1).cast("long")}), "source-ranges")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    listed = prefix_sums(ranged, [], "range", [last], "one", "source_no").withColumn("weight", weight)
    return fill(stage_table(listed, "weights")).select("source_no", "source", "source_size", "target")


def streams(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents with their place in their source's stream of words, and the sources."""
    documents = stage_table(sized(docs), "sizes")
    sources = stage_table(source_targets(documents), "sources")
    bits = max(0, math.ceil(math.log2(max(1, documents.count()) / ROWS_PER_BUCKET)))
    placed = (attach(documents, sources, ["source"])
              .withColumn("part", F.shiftright("order_key", 60 - bits)))
    placed = prefix_sums(placed, ["source_no"], "part", ["order_key", "doc_id", "key_a", "key_b"], "size", "start")
    return stage_table(placed.drop("part"), "streams"), sources


def _piece(block: Column, block_words: int) -> dict[str, Column]:
    """Where a document's part in a block lies, in the block and in the document."""
    begin = F.greatest(F.col("start"), block * block_words)
    end = F.least(F.col("start") + F.col("size"), (block + 1) * block_words)
    return {"in_block": begin - block * block_words, "first_word": begin - F.col("start"), "n_words": end - begin}


def _blocks_of(block_words: int) -> Column:
    return F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))


def blocks(placed: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per piece of a document in a block: where in the block and in the document."""
    return (placed.filter("size > 0").withColumn("block", F.explode(_blocks_of(block_words)))
            .select("source_no", "block", "doc_id", "start",
                    *(c.alias(n) for n, c in _piece(F.col("block"), block_words).items())))


def text_blocks(placed: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """:func:`blocks` with the pieces' words, joined by spaces; ``placed`` has ``text``."""
    def piece(of_text: Column, block: Column) -> Column:
        at = _piece(block, block_words)
        cut = F.slice(of_text, (at["first_word"] + 1).cast("int"), at["n_words"].cast("int"))
        return F.struct(block.alias("block"), *(c.alias(n) for n, c in at.items()), F.array_join(cut, " ").alias("text"))

    # The outer transform, over one element, is what splits a text once and not for each piece.
    pieces = F.transform(F.array(words(F.col("text"))),
                         lambda of_text: F.transform(_blocks_of(block_words), lambda block: piece(of_text, block)))
    return placed.filter("size > 0").select("source_no", "doc_id", "start", F.inline(pieces[0]))


def _drawn(plan: DataFrame, total: int) -> DataFrame:
    """position and source_no of each of the first ``total`` points: the source whose share of
    the slots, laid side by side, the point falls into."""
    cells = 1024 + 4 * plan.count()

    def cell(x: Column) -> Column:
        return F.least(F.floor(x * cells), F.lit(cells - 1))

    ends = plan.select("source_no", (F.col("before") / total).alias("low"),
                       ((F.col("before") + F.col("slots")) / total).alias("high"))
    shares = stage_table(ends.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high"))))), "shares")
    if table_bytes(shares) <= BROADCAST_BYTES:
        shares = F.broadcast(shares)
    points = plan.sparkSession.range(total).select(F.col("id").alias("position"), golden_points(F.col("id")).alias("x"))
    return (points.withColumn("cell", cell(F.col("x"))).join(shares, "cell")
            .filter((F.col("x") >= F.col("low")) & (F.col("x") < F.col("high"))).select("position", "source_no"))


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per slot: position, source_no, epoch, block and how many of its words count."""
    one, of_range = F.lit(1).cast("long"), F.floor(F.col("source_no") / SOURCES_PER_RANGE)
    slots = F.expr(f"target_words div source_size * blocks + (rest + {block_words - 1}) div {block_words}")
    sized_plan = (sources.withColumn("target_words", F.floor("target")).filter("target_words > 0")
                  .select("source_no", of_range.alias("range"), "target_words", "source_size",
                          F.expr(f"(source_size + {block_words - 1}) div {block_words}").alias("blocks"),
                          (F.col("target_words") % F.col("source_size")).alias("rest"))
                  .withColumn("slots", slots))
    plan = stage_table(prefix_sums(stage_table(sized_plan, "plan"), [], "range", ["source_no"], "slots", "before"),
                       "plan-slots")
    total = plan.agg(F.sum("slots")).first()[0] or 0
    drawn = stage_table(_drawn(plan, total).withColumns({"chunk": F.floor(F.col("position") / CHUNK), "one": one}), "points")
    ranked = prefix_sums(drawn, ["source_no"], "chunk", ["position"], "one", "rank").select(
        "position", "source_no", "rank")
    # The sequence is off a source's share by a few slots: those are added at the end.
    counts = stage_table(drawn.groupBy("source_no").agg(F.count("*").alias("drawn")), "drawn")
    late = (attach(plan, counts, ["source_no"]).withColumn("first", F.coalesce("drawn", F.lit(0)))
            .withColumn("missing", F.col("slots") - F.col("first")).filter("missing > 0"))
    placed = prefix_sums(stage_table(late.select("source_no", "range", "first", "slots", "missing"), "late"),
                         [], "range", ["source_no"], "missing", "place")
    more = (placed.withColumn("rank", F.explode(F.sequence(F.col("first"), F.col("slots") - 1)))
            .select((F.lit(total) + F.col("place") + F.col("rank") - F.col("first")).alias("position"), "source_no", "rank"))
    # Words that count in the last slot; all others count whole.
    cut = F.when((F.col("rank") == F.col("slots") - 1) & (F.col("rest") > 0),
                 F.col("rest") - F.col("block") * block_words).otherwise(F.lit(block_words))
    numbers = plan.select("source_no", "slots", "blocks", "rest")
    return (attach(ranked.unionByName(more), numbers, ["source_no"], "inner").filter(F.col("rank") < F.col("slots"))
            .withColumn("epoch", F.floor(F.col("rank") / F.col("blocks")))
            .withColumn("block", F.col("rank") % F.col("blocks"))
            .select("position", "source_no", "epoch", "block", cut.alias("cut")))


def _fill_slots(pieces: DataFrame, sources: DataFrame, block_words: int) -> DataFrame:
    """The pieces at each position of their block, with ``taken``, their words that count."""
    slots = schedule(sources, block_words).withColumnsRenamed({"source_no": "slot_source", "block": "slot_block"})
    taken = F.least(F.col("n_words"), F.col("cut") - F.col("in_block"))
    on = (F.col("slot_source") == F.col("source_no")) & (F.col("slot_block") == F.col("block"))
    return slots.join(pieces, on).withColumn("taken", taken).filter("taken > 0")


def mix(placed: DataFrame, sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix, one row per slot and piece of a document: position, in_block (the order in
    the slot), source_no, doc_id, start, first_word and n_words."""
    filled = _fill_slots(blocks(placed, block_words), sources, block_words)
    return filled.select("position", "in_block", "source_no", "epoch", "doc_id", "start", "first_word",
                         F.col("taken").alias("n_words"))


def mixed_texts(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix to be read from start to end: :func:`mix` with ``source`` and ``text``, the words
    of each piece joined by spaces, in ranges of position and sorted by position and in_block."""
    placed, sources = streams(docs)
    texts = docs.select("text", *(k.alias(f"__{n}") for k, n in zip(row_key(), ("a", "b")))).dropDuplicates(["__a", "__b"])
    whole = placed.join(texts, (F.col("key_a") == F.col("__a")) & (F.col("key_b") == F.col("__b")))
    filled = _fill_slots(text_blocks(whole, block_words), sources, block_words)
    cut = F.array_join(F.slice(F.split("text", " "), 1, F.col("taken").cast("int")), " ")
    text = F.when(F.col("taken") < F.col("n_words"), cut).otherwise(F.col("text"))
    named = attach(filled, sources.select("source_no", "source"), ["source_no"], "inner")
    return (named.select("position", "in_block", "source", "epoch", "doc_id", "first_word",
                         F.col("taken").alias("n_words"), text.alias("text"))
            .repartitionByRange("position").sortWithinPartitions("position", "in_block"))


def taken_words(docs: DataFrame) -> DataFrame:
    """Every document's size, its source's size and target, and the words the mix takes."""
    placed, sources = streams(docs)
    taken = (mix(placed, sources).groupBy(F.col("source_no").alias("__no"), F.col("start").alias("__start"))
             .agg(F.sum("n_words").alias("taken")))
    on = (F.col("source_no") == F.col("__no")) & (F.col("start") == F.col("__start")) & (F.col("size") > 0)
    return placed.join(taken, on, "left").select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "key_a", "key_b")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents as the mix takes them, with their columns: a row for each time a
    document is taken. The one document of a source that its target cuts has its first
    words, joined by spaces; ``n_chars``, if there, follows. Rows equal in doc_id, source
    and text are one document whose takes add up."""
    names = docs.columns
    key_a, key_b = (k.alias(f"__{n}") for k, n in zip(row_key(), ("key_a", "key_b")))
    takes = (taken_words(docs).groupBy(F.col("key_a").alias("__a"), F.col("key_b").alias("__b"))
             .agg(F.sum("taken").alias("__taken"), F.first("size").alias("__size")).filter("__taken > 0"))
    once = docs.select("*", key_a, key_b).dropDuplicates(["__key_a", "__key_b"])
    joined = once.join(takes, (F.col("__key_a") == F.col("__a")) & (F.col("__key_b") == F.col("__b")))
    copies = joined.withColumn("__copy", F.explode(F.sequence(
        F.lit(1).cast("long"), F.ceil(F.col("__taken") / F.col("__size")))))
    left = F.col("__taken") - (F.col("__copy") - 1) * F.col("__size")
    cut = F.when(left < F.col("__size"),
                 F.array_join(F.slice(words(F.col("text")), 1, left.cast("int")), " ")).otherwise(F.col("text"))
    result = copies.withColumn("text", cut)
    if "n_chars" in names:
        result = result.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return result.select(*names)
