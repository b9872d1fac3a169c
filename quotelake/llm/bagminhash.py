"""MinHash near-duplicates by weighted Jaccard: BagMinHash signatures, bands, verified overlap.

A text is the multiset of its shingles of five lower-cased words (a shorter text is one
shingle of all its words). A shingle that stands w times owns the levels 0..w. Its points in
time come from Poisson processes over dyadic parts of the levels, [0,1), [1,2), [2,4), ...:
a part is drawn whole, with points for every weight alike, and points above w are left out,
so a weight costs its logarithm. Each point falls into one of the signature's slots, and a
slot keeps its earliest point: two texts agree in a slot with the probability of their
weighted Jaccard similarity. Points later than a text's latest slot cannot count and are not
drawn; a slice of texts is drawn at once in numpy.

Bands of slots are hashed to buckets. Equal texts are one node from the start (64-bit
digest). Within a bucket, nodes are compared by the exact overlap of their bags, first those
whose signatures allow 80 %; nodes already connected are not compared, and a pair belongs to
the first bucket that it shares. A bucket is cut into blocks of ``BLOCK`` nodes: a first round
compares within blocks, a second compares, in buckets that still hold several components,
the nodes outside the largest one with all others, block by block. So no pairs are listed,
only links of a spanning forest, no task holds more than two blocks of a bucket at a time,
and no link is lost. Components come from label propagation with pointer jumping.

Class ids are the smallest doc_id of the class. Texts without a word, null ones too, are one class. A null
doc_id counts as none: it is a class id only of a class without others. Repeated rows are in
one class. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from quotelake.llm.common import BROADCAST_BYTES, attach, ship_package, stage_table, table_bytes
from quotelake.llm.text_slices import SLICE_BYTES, slices

SHINGLE = 5
SLOTS = 80
BANDS = 20
PERCENT = 80
BLOCK = 512
ROW_BYTES = 500  # of a row's numbers in Python
SIGNED_BYTES = 1 << 20  # of texts whose signatures are drawn together
# Texts at the threshold share fewer slots in one case of 300,000.
LEAST_EQUAL = int(SLOTS * PERCENT / 100 - 4.5 * (SLOTS * PERCENT * (100 - PERCENT)) ** 0.5 / 100)

_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def shingle_bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, ascending, and how often each stands."""
    tokens = (text or "").lower().encode().split()
    if not tokens:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), dtype=np.uint64, count=len(tokens))
    size = min(SHINGLE, len(codes))
    windows = len(codes) - size + 1
    keys = np.full(windows, size, dtype=np.uint64)
    for i in range(size):
        keys = _mixed((keys ^ codes[i:i + windows]) * _ODD[0])
    return np.unique(keys, return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], slots: int = SLOTS) -> np.ndarray:
    """One row of slot times per bag; infinite for an empty bag."""
    times = np.full((len(bags), slots), np.inf)
    lengths = [len(b[0]) for b in bags]
    if not sum(lengths):
        return times
    element = np.concatenate([b[0] for b in bags])
    weight = np.concatenate([b[1] for b in bags]).astype(np.float64)
    owner = np.repeat(np.arange(len(bags)), lengths)
    # The parts of the levels that each element reaches: all reach [0, 1).
    reach, low = [np.arange(len(element))], [np.zeros(len(element))]
    step = 1.0
    while (more := np.flatnonzero(weight > step)).size:
        reach.append(more)
        low.append(np.full(len(more), step))
        step *= 2
    low_, chosen = np.concatenate(low), np.concatenate(reach)
    width = np.maximum(low_, 1.0)
    seed = _mixed(element[chosen] + low_.astype(np.uint64) * _ODD[0])
    owner, weight = owner[chosen], weight[chosen]
    now, drawn = np.zeros(len(seed)), 0
    flat = times.reshape(-1)
    while len(seed):
        # The fewer processes are left, the more of their points are drawn at once.
        ahead = int(np.clip(50_000 // len(seed), 1, 32))
        number = np.arange(drawn + 1, drawn + ahead + 1, dtype=np.uint64) * _ODD[0]
        first = _mixed(seed[:, None] + number[None, :])
        second = _mixed(first ^ _ODD[1])
        waits = -np.log(_unit(first)) / width[:, None]
        at = np.cumsum(np.concatenate((now[:, None], waits), axis=1), axis=1)[:, 1:]
        inside = low_[:, None] + width[:, None] * _unit(_mixed(second ^ _ODD[2])) < weight[:, None]
        slot = owner[:, None] * slots + (second % np.uint64(slots)).astype(np.int64)
        better = inside & (at < flat[slot])
        np.minimum.at(flat, slot[better], at[better])
        latest = times.max(axis=1)
        now, drawn = at[:, -1], drawn + ahead
        left = now < latest[owner]
        seed, owner, weight, low_, width, now = (x[left] for x in (seed, owner, weight, low_, width, now))
    return times


def band_hashes(times: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One row of band hashes per signature; the band's number is part of the hash."""
    cells = times.view(np.uint64).reshape(len(times), bands, -1)
    hashes = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), cells.shape[:2])
    for i in range(cells.shape[2]):
        hashes = _mixed((hashes ^ cells[:, :, i]) * _ODD[0])
    return hashes.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Size of the multiset intersection and of the union of two bags."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both, int(a[1].sum() + b[1].sum()) - both


def digest(text: str = "text") -> Column:
    """The node of a text: equal texts are one node."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1), kind))


def banded(docs: DataFrame) -> DataFrame:
    """doc_id, node and the band hashes of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, SIGNED_BYTES):
                times = signatures([shingle_bag(t.as_py()) for t in part.column(2)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), _lists(band_hashes(times), pa.int64())],
                    names=["doc_id", "node", "bands"])

    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), digest().alias("node"), "text")
    return rows.mapInArrow(run, "doc_id long, node long, bands array<long>")


def flat_bag(bag: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The bag as a set of 32-bit numbers, one per standing of a shingle, ascending."""
    element, times = bag
    nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    return np.sort(_mixed(np.repeat(element, times) + nth.astype(np.uint64) * _ODD[0]).astype(np.uint32))


def overlaps(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two flat bags share ``PERCENT`` of their union."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(large):
        return True
    if 100 * len(small) < PERCENT * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


class _Groups:
    """Sets joined by links."""

    def __init__(self, labels: list[int]) -> None:
        self.up = {label: label for label in labels}

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.find(x)] = self.find(y)


def _block_links(rows: pa.RecordBatch) -> list[tuple[int, int]]:
    """Links that connect what the rows of one block, or of a pair of blocks, hold."""
    node, label, band, side = (rows.column(n).to_pylist() for n in ("node", "label", "band", "side"))
    groups = _Groups(label)
    bags = [np.frombuffer(b.as_py(), np.uint32) for b in rows.column("bag")]
    marks = np.frombuffer(b"".join(b.as_py() for b in rows.column("bands")), np.uint32).reshape(len(node), -1)
    slots = np.frombuffer(b"".join(b.as_py() for b in rows.column("slots")), np.uint16).reshape(len(node), -1)
    links = []
    halves = 1 in side  # a pair of blocks: the left rows against the right ones
    right = np.array([i for i, s in enumerate(side) if s == 1], dtype=np.int64)
    before = band[0]
    for x in range(len(node)):
        if halves and side[x] == 1:
            continue
        others = right if halves else np.arange(x + 1, len(node))
        if not len(others):
            continue
        equal = (slots[others] == slots[x]).sum(axis=1)
        fit = equal >= LEAST_EQUAL
        if before:
            fit &= ~(marks[others, :before] == marks[x, :before]).any(axis=1)
        for y in others[fit][np.argsort(-equal[fit], kind="stable")].tolist():
            if groups.find(label[x]) != groups.find(label[y]) and overlaps(bags[x], bags[y]):
                groups.join(label[x], label[y])
                links.append((node[x], node[y]))
    return links


_MEMBER = "bucket long, part long, node long, label long, band int, side int, bands binary, slots binary, bag binary"
_MEMBER_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(),
                 pa.binary(), pa.binary(), pa.binary())
_MEMBER_NAMES = [field.split()[0] for field in _MEMBER.split(", ")]


def _members(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The rows to compare. ``places`` has a node's first_id, label and an array of bucket,
    part and side; each becomes a row with the node's band marks, slots and bag. A node of
    a large bucket has many places, so rows leave in batches of ``SLICE_BYTES``."""
    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*out), _MEMBER_TYPES)], names=_MEMBER_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, SIGNED_BYTES):
                bags = [shingle_bag(t.as_py()) for t in part.column(0)]
                times = signatures(bags)
                hashes = band_hashes(times)
                marks = hashes.view(np.uint64).astype(np.uint32)
                slots = _mixed(times.view(np.uint64)).astype(np.uint16)
                out, size = [], 0
                for i, (node, label) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                    band = {h: b for b, h in enumerate(hashes[i].tolist())}
                    own = marks[i].tobytes(), slots[i].tobytes(), flat_bag(bags[i]).tobytes()
                    weight = sum(map(len, own)) + ROW_BYTES
                    where = part.column(3)[i].values
                    for bucket, block, side in zip(*(where.field(k).to_numpy() for k in ("bucket", "part", "side"))):
                        out.append((bucket, block, node, label, band[int(bucket)], side, *own))
                        size += weight
                        if size >= SLICE_BYTES:
                            yield rows(out)
                            out, size = [], 0
                if out:
                    yield rows(out)

    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), digest().alias("__node"), "text")
    places_size = table_bytes(places) + 24 * (places.agg(F.sum(F.size("places"))).first()[0] or 0)
    small = F.broadcast(places) if places_size <= BROADCAST_BYTES else places
    joined = texts.join(small, (F.col("__node") == F.col("node")) & F.col("__id").eqNullSafe(F.col("first_id")))
    return joined.select("text", "node", "label", "places").mapInArrow(run, _MEMBER)


def _links(members: DataFrame) -> DataFrame:
    """Links (a, b) found in each part of a bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        last = None

        def close() -> pa.RecordBatch:
            links = _block_links(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
            waiting.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([f(x) for x in links], pa.int64()) for f in (min, max)], names=["a", "b"])

        for batch in batches:
            bucket, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = (np.flatnonzero((np.diff(bucket) != 0) | (np.diff(part) != 0)) + 1).tolist()
            for start, stop in zip([0, *edges], [*edges, batch.num_rows]):
                if stop > start:
                    key = (bucket[start], part[start])
                    if waiting and key != last:
                        yield close()
                    waiting.append(batch.slice(start, stop - start))
                    last = key
        if waiting:
            yield close()

    grouped = members.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "node")
    return grouped.mapInArrow(run, "a long, b long").filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and label, the smallest node connected with it, of the nodes of links (a, b)."""
    edges = stage_table(links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")), "edges")
    labels = stage_table(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v")).select(
        "node", F.least("node", "v").alias("label")), "labels")
    while True:
        nearest = edges.join(labels, edges["v"] == labels["node"]).groupBy("u").agg(F.min("label").alias("near"))
        lower = labels.join(nearest, F.col("node") == F.col("u")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("new"))
        target = labels.select(F.col("node").alias("__node"), F.col("label").alias("__label"))
        jumped = stage_table(lower.join(target, F.col("new") == F.col("__node")).select(
            "node", F.least("new", "__label").alias("label"), (F.least("new", "__label") != F.col("old")).alias("moved")),
            "labels")
        labels = jumped.select("node", "label")
        if not jumped.filter("moved").limit(1).count():
            return labels


def _part(parts: Column) -> Column:
    return F.pmod(F.xxhash64("node", "bucket"), parts)


def node_labels(docs: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """node and label of every node that is linked to another; ``rows`` are staged ``banded`` ones."""
    listed = rows.select("node", F.explode("bands").alias("bucket"))
    shared = (listed.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
              .filter("low != high").select("bucket"))
    inside = stage_table(listed.join(shared, "bucket").distinct(), "buckets")
    first = rows.groupBy("node").agg(F.min("doc_id").alias("first_id"))
    large = stage_table(inside.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > block)
                        .select("bucket", F.ceil(F.col("n") / block).alias("parts")), "large")

    def places(rows_: DataFrame) -> DataFrame:
        nodes = rows_.groupBy("node", "label").agg(F.collect_list(F.struct("bucket", "part", "side")).alias("places"))
        return stage_table(nodes.join(first, "node"), "places")

    once = attach(inside, large, ["bucket"]).select(
        "bucket", "node", F.col("node").alias("label"), F.lit(0).alias("side"),
        _part(F.coalesce("parts", F.lit(1))).alias("part"))
    links = stage_table(_links(_members(docs, places(once))), "links")
    labels = components(links)
    if not large.count():
        return labels

    # Second round: in cut buckets, the nodes outside the largest component against all.
    known = labels.select(F.col("node").alias("__node"), "label")
    cut = stage_table(attach(inside, large, ["bucket"], "inner").join(known, F.col("node") == F.col("__node"), "left").select(
        "bucket", "parts", "node", F.coalesce("label", "node").alias("label")), "cut")
    counts = cut.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    most = counts.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"))
    most = stage_table(most.filter(F.col("top.n") < F.col("all")).select(
        "bucket", F.col("top.label").alias("top"), F.ceil((F.col("all") - F.col("top.n")) / block).alias("outside")), "most")
    again = attach(cut, most, ["bucket"], "inner")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    right = again.select("bucket", "node", "label", F.lit(1).alias("side"), "parts",
                         _part(F.col("parts")).alias("own"), every("outside").alias("other"))
    left = again.filter("label != top").select("bucket", "node", "label", F.lit(0).alias("side"), "parts",
                                               every("parts").alias("own"), _part(F.col("outside")).alias("other"))
    pairs = left.unionByName(right).withColumn("part", F.col("other") * F.col("parts") + F.col("own"))
    more = stage_table(_links(_members(docs, places(pairs))), "links")
    return components(links.unionByName(more)) if more.limit(1).count() else labels


def labelled(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, node and label of every document."""
    rows = stage_table(banded(docs), "bands")
    labels = stage_table(node_labels(docs, rows, block).withColumnRenamed("node", "__node"), "node-labels")
    return stage_table(rows.join(labels, F.col("node") == F.col("__node"), "left").select(
        "doc_id", "node", F.coalesce("label", "node").alias("label")), "labelled")


def classes(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id and class_id of every document."""
    rows = labelled(docs, block)
    ids = rows.groupBy(F.col("label").alias("__label")).agg(F.min("doc_id").alias("class_id"))
    return rows.join(ids, F.col("label") == F.col("__label")).select("doc_id", "class_id")


def one_of_each(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The documents with their columns, one of each class: that with the smallest doc_id."""
    rows = labelled(docs, block)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    keys = rows.groupBy("label").agg(F.min(order).alias("first")).select(
        F.col("first.doc_id").alias("__id"), F.col("first.node").alias("__node"))
    counted = rows.groupBy("doc_id", "node").agg(F.count("*").alias("n"))
    same = counted["doc_id"].eqNullSafe(keys["__id"]) & (counted["node"] == keys["__node"])
    named = [F.col("doc_id").alias("__id"), F.col("node").alias("__node")]
    dropped = stage_table(counted.join(keys, same, "left_anti").select(*named), "dropped")
    repeated = stage_table(counted.filter("n > 1").join(keys, same, "left_semi").select(*named), "repeated")

    def join(frame: DataFrame, other: DataFrame, how: str) -> DataFrame:
        small = F.broadcast(other) if table_bytes(other) <= BROADCAST_BYTES else other
        return frame.join(small, frame["doc_id"].eqNullSafe(small["__id"]) & (digest() == small["__node"]), how)

    left = join(docs, dropped, "left_anti")
    if not repeated.limit(1).count():
        return left
    once = join(docs, repeated, "left_semi").withColumn("__digest", digest()).dropDuplicates(["doc_id", "__digest"])
    return join(left, repeated, "left_anti").unionByName(once.drop("__digest"))
