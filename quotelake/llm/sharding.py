"""Sharding by extendible hashing: shards are prefixes of the document's hash bits.

The directory starts with one bucket; a bucket above the byte limit splits on its next hash
bit, others stay, until every shard fits. The sizes of all prefixes a split can need are
sums over cells, the finest prefixes, so documents are read once for the directory and once
to be placed; the cells' number follows the number of shards.

The hash is of doc_id and text. A document above the limit by itself, or rows equal in both,
cannot be split by any bit: such a shard ends at the last bit and has ``oversized`` set. Null
ids and texts are hashed as such, empty texts have 0 bytes; an empty table has no shards;
other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from quotelake.llm.common import attach, shuffle_key, stage_table

LIMIT_BYTES = 64 * 1024 * 1024
BITS = 60
SPARE_BITS = 4


def hashed(docs: DataFrame) -> DataFrame:
    """doc_id, bytes and 60 hash bits of every document."""
    return docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
                       shuffle_key(F.col("doc_id"), F.md5("text")).alias("hash"))


def prefix(depth: int | Column, bits: Column | None = None) -> Column:
    """The first ``depth`` hash bits as a number."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", F.col("hash") if bits is None else bits, (F.lit(BITS) - depth).cast("int"))


def _split(cells: DataFrame, above: int, depth: int, limit: int) -> DataFrame:
    """cell, and depth, bytes and oversized of its shard: the shortest of its prefixes longer
    than ``above`` that fits; depth is null where the cell itself does not fit yet."""
    sums = (cells.withColumn("d", F.explode(F.sequence(F.lit(above), F.lit(depth))))
            .withColumn("p", F.call_function("shiftright", F.col("cell"), (F.lit(depth) - F.col("d")).cast("int")))
            .groupBy("d", "p").agg(F.sum("bytes").alias("shard_bytes")))
    last = F.lit(depth == BITS)
    fits = sums.filter((F.col("shard_bytes") <= limit) | (last & (F.col("d") == BITS)))
    keyed = cells.select("cell").withColumn("d", F.explode(F.sequence(F.lit(above), F.lit(depth)))).withColumn(
        "p", F.call_function("shiftright", F.col("cell"), (F.lit(depth) - F.col("d")).cast("int")))
    # Merge joins: Spark takes the exploded cells for no larger than the file of cells, and broadcasts them.
    first = keyed.join(fits.hint("merge"), ["d", "p"]).groupBy("cell").agg(
        F.min(F.struct("d", "shard_bytes")).alias("shard"))
    return cells.select("cell").join(first.hint("merge"), "cell", "left").select(
        "cell", F.col("shard.d").alias("depth"), F.col("shard.shard_bytes").alias("shard_bytes"))


def directory(rows: DataFrame, limit: int = LIMIT_BYTES) -> list[tuple[int, DataFrame]]:
    """The directory of hashed rows, in levels: (bits of a cell, table of cell, depth,
    shard_bytes). A cell without depth is looked up in the next level."""
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    depth = min(BITS, max(0, math.ceil(math.log2(max(1, total) / limit))) + SPARE_BITS)
    levels, above, open_rows = [], 0, rows
    while True:
        cells = stage_table(open_rows.groupBy(prefix(depth).alias("cell")).agg(F.sum("bytes").alias("bytes")), "cells")
        level = stage_table(_split(cells, above, depth, limit), "directory")
        levels.append((depth, level))
        too_large = level.filter("depth is null")
        if not too_large.count():
            return levels
        # Its rows lie in the open cells of all levels above.
        open_rows = attach(rows.withColumn("cell", prefix(depth)), too_large.select("cell").hint("merge"), ["cell"], "left_semi")
        above, depth = depth + 1, min(BITS, depth + 8)


def shard(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """doc_id, bytes, shard (its bits as text), depth, shard_bytes and oversized of every document."""
    rows = stage_table(hashed(docs), "hashes")
    levels = directory(rows, limit)
    placed = rows.withColumn("depth", F.lit(None).cast("int")).withColumn("shard_bytes", F.lit(None).cast("long"))
    for bits, level in levels:
        # The hint holds beyond the size for a broadcast: a small file has many rows of this table.
        found = attach(placed.withColumn("cell", prefix(bits)), level.select(
            "cell", F.col("depth").alias("here"), F.col("shard_bytes").alias("here_bytes")).hint("merge"), ["cell"])
        placed = found.select("doc_id", "bytes", "hash", F.coalesce("depth", "here").alias("depth"),
                              F.coalesce("shard_bytes", "here_bytes").alias("shard_bytes"))
    # A leading 1 keeps the zeros of the prefix.
    bits = F.conv((prefix(F.col("depth")) + F.call_function("shiftleft", F.lit(1).cast("long"), F.col("depth"))).cast("string"), 10, 2)
    return placed.select("doc_id", "bytes", F.substr(bits, F.lit(2)).alias("shard"), "depth", "shard_bytes",
                         (F.col("shard_bytes") > limit).alias("oversized"))
