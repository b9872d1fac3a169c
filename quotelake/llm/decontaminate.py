"""Benchmark decontamination: find test items inside documents by MinHash containment.

A text is the set of its shingles of five lower-cased words. A document is contaminated by
an item when it holds 80 % of the item's shingles. Items are partitioned by size, in powers
of two. Each keeps the smallest of its shingles' hashes, as many as its partition's largest
item may miss plus one: a document that holds 80 % of an item must hold one of those, so the
search loses nothing however long the document is, which signatures of whole documents
against items of thirty words would. Documents that hit are verified by counting the item's
shingles in them, as strings.

Only documents that hit are shuffled. The sketch is broadcast up to a measured size and
joined by shuffle beyond. Null and empty texts, and texts under five words, have no shingle:
such documents are clean and such items match nothing. A null doc_id is an id like others.
Rows that repeat an id are searched each and reported once. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quotelake.llm.common import BROADCAST_BYTES, stage_table, table_bytes, words

SHINGLE = 5
PERCENT = 80


def _windows(tokens: Column, make) -> Column:
    """One value per window of ``SHINGLE`` words; empty for shorter texts."""
    heads = F.slice(tokens, 1, F.greatest(F.size(tokens) - (SHINGLE - 1), F.lit(0)))
    return F.transform(heads, lambda w, i: make(w, *(F.get(tokens, i + k) for k in range(1, SHINGLE))))


def shingles(rows: DataFrame, *keys: str) -> DataFrame:
    """The keys and one row per distinct shingle of ``text``, as a string."""
    split = rows.select(*keys, words(F.lower("text")).alias("__w"))
    return split.select(*keys, F.explode(F.array_distinct(
        _windows(F.col("__w"), lambda *w: F.concat_ws(" ", *w)))).alias("shingle"))


def shingle_hashes(rows: DataFrame, *keys: str) -> DataFrame:
    """The keys and the hash of every shingle of ``text``."""
    split = rows.select(*keys, words(F.lower("text")).alias("__w"))
    return split.select(*keys, F.explode(_windows(F.col("__w"), F.xxhash64)).alias("hash"))


def sketches(items: DataFrame) -> DataFrame:
    """item_id, n (shingles) and the hashes to look for, one row per hash."""
    listed = shingles(items, "item_id").groupBy("item_id").agg(
        F.collect_set("shingle").alias("all")).withColumn("n", F.size("all"))
    listed = listed.withColumn("part", F.floor(F.log2("n")))
    largest = F.pow(F.lit(2), F.col("part") + 1).cast("int") - 1
    keep = F.floor(largest * (100 - PERCENT) / 100).cast("int") + 1
    # The same hash of five words as in shingle_hashes.
    hashes = F.transform("all", lambda s: F.xxhash64(*(F.get(F.split(s, " "), F.lit(k)) for k in range(SHINGLE))))
    return listed.withColumn("hashes", F.array_sort(hashes)).select(
        "item_id", "n", F.explode(F.slice("hashes", 1, keep)).alias("hash"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if table_bytes(df) <= BROADCAST_BYTES else df


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, digest (of the text), item_id, n_found and n_shingles of every pair."""
    items = stage_table(items.select("item_id", "text").dropDuplicates(), "items")
    sketch = stage_table(sketches(items), "sketch")
    hits = (shingle_hashes(docs, "doc_id").join(_small(sketch.select("hash").distinct()), "hash")
            .select("doc_id").distinct())
    found_docs = stage_table(hits.withColumnRenamed("doc_id", "__hit"), "hits")
    suspects = docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    suspects = suspects.join(_small(found_docs), F.col("doc_id").eqNullSafe(F.col("__hit")), "left_semi")
    listed = stage_table(shingles(items, "item_id"), "item-shingles")
    sizes = stage_table(listed.groupBy("item_id").agg(F.count("*").alias("n_shingles")), "item-sizes")
    found = (shingles(suspects.dropDuplicates(["doc_id", "digest"]), "doc_id", "digest").join(_small(listed), "shingle")
             .groupBy("doc_id", "digest", "item_id").agg(F.count("*").alias("n_found")))
    return (found.join(_small(sizes), "item_id")
            .filter(100 * F.col("n_found") >= PERCENT * F.col("n_shingles"))
            .select("doc_id", "digest", "item_id", "n_found", "n_shingles"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id and the share of the item's shingles found, one row per pair."""
    return (contaminated(docs, items).groupBy("doc_id", "item_id", "n_shingles")
            .agg(F.max("n_found").alias("n_found")).select("doc_id", "item_id", "n_found", "n_shingles"))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    bad = contaminated(docs, items).select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    bad = stage_table(bad, "contaminated")
    return docs.join(_small(bad), docs["doc_id"].eqNullSafe(F.col("__id"))
                     & (F.xxhash64(docs["text"]) == F.col("__digest")), "left_anti")
