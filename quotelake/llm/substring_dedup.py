"""Substring dedup: content-defined chunks cut by a gear rolling hash, deduplicated by digest.

Wherever ``MIN_CHARS`` characters stand in two texts, both choose the same anchor of ``KEY``
characters in them: that of the smallest gear hash (of its last 16 characters) among all that
lie in the window. An anchor's chunk is what its windows cover together, from ``MIN_CHARS`` to
about 170 characters: where it begins and ends is decided by gear hashes alone, so an insertion
changes the chunks that reach over it and no others. Neighbouring chunks overlap, and every
window of ``MIN_CHARS`` characters lies in a chunk. (Chunks cut apart lose passages: those at
either end go over into what stands beside it, and what is left may be too short.) Equal anchors
that follow each other closely, as in repetitions of a word, are thinned as far as each window
still has one.

Chunks are deduplicated by digest. Of an anchor whose chunks are all equal, the chunk is shared.
Of an anchor with several chunks, each different one is compared by the digests of its windows,
and those are shared that stand in two documents: in one task per anchor, which gets the chunks'
characters, or for anchors of more than ``GROUP`` chunks by a row per window. So every shared
passage of ``MIN_CHARS`` characters is found, to its first and last character; two texts are
taken as equal by 64-bit digests.

The smallest doc_id with a shared window keeps it. A passage is a run of shared windows, each
one character after the last, that one document keeps. Those that a document keeps itself may
overlap. Of the others count the characters outside of kept ones, from ``MIN_CHARS`` in a row,
divided where the passage changes. A part under ``MIN_CHARS`` goes with the part beside it if
their passages go ``OVERLAP`` characters into each other; else it is no passage, and is left.
Without the passages that others keep, each shared window is left in the document that keeps it.

Rows equal in doc_id and text are one document. A null doc_id is after all others. Null and
empty texts have no anchor; one text of any length is handled by one task. An empty table
gives no rows. ``find_repeats`` reads doc_id and text only; ``remove_repeats`` keeps all columns.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quotelake.llm.common import attach, ship_package, stage_table
from quotelake.llm.text_slices import slices

OVERLAP = 40  # characters by which passages go into each other that are told as one
KEY = 32
MIN_CHARS = 100

# One random number per byte value.
GEAR = np.random.default_rng(20240101).integers(0, 1 << 16, 256, dtype=np.uint16)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """At each byte, the gear hash of it and the 15 before: the sum of the bytes' numbers,
    each shifted by its distance."""
    total = GEAR[data]
    for width in (1, 2, 4, 8):
        before = np.zeros_like(total)
        before[width:] = total[:-width] << np.uint16(width)
        total = total + before
    return total


_NONE = 2 ** 63 - 1
GROUP = 4096        # chunks of an anchor that one task compares
TOGETHER = 8192     # chunks that a task compares at once, about

BASE = 0x9E3779B97F4A7C15  # odd: powers have inverses modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    result = np.full(n + 1, base, dtype=np.uint64)
    result[0] = 1
    return np.cumprod(result, dtype=np.uint64)


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le"), dtype=np.uint32)


class Digests:
    """Digests of any parts of a text, by sums of its characters times powers of a number."""

    def __init__(self, codes: np.ndarray) -> None:
        values = _scramble(codes.astype(np.uint64) + np.uint64(BASE))
        self.sums = np.append(np.uint64(0), np.cumsum(values * _powers(INVERSE, len(codes))[:-1], dtype=np.uint64))
        self.powers = _powers(BASE, len(codes))

    def of(self, begins: np.ndarray, ends: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        part = (self.sums[ends] - self.sums[begins]) * self.powers[begins]
        length = np.asarray((ends - begins) * 65536 + salt, dtype=np.uint64)
        return _scramble(part ^ _scramble(length + np.uint64(1))).view(np.int64)


def slide(values: np.ndarray, width: int, fold: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The fold of each ``width`` values in a row, by doubling the window."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = fold(values[:-step], values[step:])
        done += step
    return values


def anchors(codes: np.ndarray, digests: Digests, min_chars: int = MIN_CHARS) -> tuple[np.ndarray, ...]:
    """Where the anchors of a text begin, their digests, and the characters before and from
    there in the windows in which none has a smaller hash."""
    key = min(KEY, min_chars)
    reach = min_chars - key + 1  # anchors to choose from in a window
    order = gear_hash((codes ^ (codes >> 8)).astype(np.uint8))[key - 1:].astype(np.uint32) + 1
    lows = np.pad(slide(order, reach, np.minimum), reach - 1)
    begins = np.flatnonzero(slide(lows, reach, np.maximum) == order)
    found = digests.of(begins, begins + key)
    if reach > 1 and len(begins) > 2:
        follows = np.append(False, (found[1:] == found[:-1]) & (np.diff(begins) <= reach // 2))
        place = np.arange(len(begins))
        part = (begins - begins[np.maximum.accumulate(np.where(follows, 0, place))]) // (reach // 2)
        keep = ~follows | ~np.append(follows[1:], False) | np.append(True, part[1:] != part[:-1])
        begins, found = begins[keep], found[keep]
    around = np.lib.stride_tricks.sliding_window_view(lows, reach)
    lead, tail = np.zeros(len(begins), np.int64), np.zeros(len(begins), np.int64)
    for i in range(0, len(begins), 1 << 16):
        some = begins[i:i + (1 << 16)]
        least = around[some] == order[some][:, None]
        lead[i:i + len(some)] = reach - 1 - least.argmax(axis=1)
        tail[i:i + len(some)] = min_chars - least[:, ::-1].argmax(axis=1)
    return begins, found, lead, tail


_ANCHOR = "doc_id long, node long, start int, lead int, tail int, digest long, chunk long"


def anchor_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, node (of the text), start of every anchor, characters of its chunk before the
    start and from it on, and digests of both."""
    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        counts, columns = [], []
        for text in part.column(2):
            codes = code_points(text.as_py())
            counts.append(0)
            if len(codes) < min_chars:
                continue
            digests = Digests(codes)
            begins, found, lead, tail = anchors(codes, digests, min_chars)
            counts[-1] = len(begins)
            columns.append((begins, lead, tail, found, digests.of(begins - lead, begins + tail, lead)))
        repeat = pa.array(np.repeat(np.arange(part.num_rows), counts))
        kinds = (np.int32, np.int32, np.int32, np.int64, np.int64)
        joined = [np.concatenate([c[i] for c in columns] or [np.zeros(0)]).astype(k) for i, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(
            [part.column(0).take(repeat), part.column(1).take(repeat), *map(pa.array, joined)],
            names=["doc_id", "node", "start", "lead", "tail", "digest", "chunk"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                yield rows(part)

    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), _node().alias("node"), "text").mapInArrow(run, _ANCHOR)


def _node() -> Column:
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


_WINDOW = "chunk long, at int, window long, low long, high long, first_id long"


def chunk_windows(docs: DataFrame, chunks: DataFrame, min_chars: int) -> DataFrame:
    """The digest of each window of ``min_chars`` characters in each chunk of (chunk, node,
    start, lead, tail, low, high, first_id), and at: where it begins, from the anchor's start."""
    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        columns = [[] for _ in range(6)]
        flat = {}
        lists = part.column(1)
        values, stops = lists.flatten(), np.cumsum(lists.value_lengths().to_numpy())
        for name in ("chunk", "start", "lead", "tail", "low", "high", "first_id"):
            flat[name] = values.field(name).to_numpy(zero_copy_only=False)
        for text, begin, stop in zip(part.column(0), [0, *stops[:-1].tolist()], stops.tolist()):
            codes = code_points(text.as_py())
            digests = Digests(codes)
            starts = flat["start"][begin:stop].astype(np.int64)
            firsts = starts - flat["lead"][begin:stop]
            sizes = flat["lead"][begin:stop] + flat["tail"][begin:stop] - min_chars + 1
            of = np.repeat(np.arange(stop - begin), sizes)
            begins = firsts[of] + np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            columns[0].append(flat["chunk"][begin:stop][of])
            columns[1].append((begins - starts[of]).astype(np.int32))
            columns[2].append(digests.of(begins, begins + min_chars))
            for column, name in zip(columns[3:], ("low", "high", "first_id")):
                column.append(flat[name][begin:stop][of])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns],
                                          names=["chunk", "at", "window", "low", "high", "first_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                for i in range(0, part.num_rows, 16):
                    yield rows(part.slice(i, 16))

    listed = chunks.groupBy(F.col("node").alias("__node")).agg(
        F.collect_list(F.struct("chunk", "start", "lead", "tail", "low", "high", "first_id")).alias("chunks"))
    texts = docs.select(_node().alias("node"), "text")
    return texts.join(listed, F.col("node") == F.col("__node")).select("text", "chunks").mapInArrow(run, _WINDOW)


_PART = "digest long, chunk long, lead int, tail int, low long, high long, first_id long, part string"
_HIT = "__chunk long, held_by long, `from` int, `to` int"


def chunk_texts(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """The chunks with their characters, cut from one of the texts that hold them."""
    names = ["digest", "chunk", "lead", "tail", "low", "high", "first_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                lists = part.column(1)
                values, sizes = lists.flatten(), lists.value_lengths().to_numpy()
                starts, leads, tails = (values.field(n).to_numpy().tolist() for n in ("start", "lead", "tail"))
                texts = np.repeat(np.arange(part.num_rows), sizes).tolist()
                held = part.column(0).to_pylist()
                cut = [held[i][start - lead:start + tail] for i, start, lead, tail in zip(texts, starts, leads, tails)]
                yield pa.RecordBatch.from_arrays([*(values.field(n) for n in names), pa.array(cut, pa.string())], names=[*names, "part"])

    listed = chunks.groupBy(F.col("node").alias("__node")).agg(F.collect_list(F.struct("start", *names)).alias("chunks"))
    texts = docs.select(_node().alias("node"), "text")
    return texts.join(listed, F.col("node") == F.col("__node")).select("text", "chunks").mapInArrow(run, _PART)


def shared_runs(rows: pa.Table, min_chars: int) -> pa.RecordBatch:
    """The runs of shared windows in the chunks of whole groups: where they begin and end from
    the anchor's start, and the first document that holds them."""
    lead, tail, low, high, first_id = (rows[n].to_numpy() for n in ("lead", "tail", "low", "high", "first_id"))
    codes = code_points("".join(rows["part"].to_pylist()))
    offsets = np.cumsum(lead + tail, dtype=np.int64) - (lead + tail)
    sizes = (lead + tail - min_chars + 1).astype(np.int64)
    of = np.repeat(np.arange(len(lead)), sizes)
    begins = offsets[of] + np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found, place = np.unique(Digests(codes).of(begins, begins + min_chars), return_inverse=True)
    least, most, held = np.full(len(found), _NONE), np.full(len(found), -_NONE), np.full(len(found), _NONE)
    np.minimum.at(least, place, low[of])
    np.maximum.at(most, place, high[of])
    np.minimum.at(held, place, first_id[of])
    hit = (least != most)[place]
    chunk, at, by = of[hit], (begins - offsets[of] - lead[of])[hit], held[place[hit]]
    order = np.lexsort((at, by, chunk))
    chunk, at, by = chunk[order], at[order], by[order]
    new = np.append(True, (chunk[1:] != chunk[:-1]) | (by[1:] != by[:-1]) | (at[1:] != at[:-1] + 1))[:len(at)]
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at))[:len(begin)] - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(rows["chunk"].to_numpy()[chunk[begin]]), pa.array(by[begin]), pa.array(at[begin].astype(np.int32)),
         pa.array((at[end] + min_chars).astype(np.int32))], names=["__chunk", "held_by", "from", "to"])


def small_groups(parts: DataFrame, min_chars: int) -> DataFrame:
    """The shared runs of anchors with few chunks: an anchor's chunks are compared in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            digest = batch.column(0).to_numpy()
            waiting.append(batch)
            size += batch.num_rows
            whole = int(np.searchsorted(digest, digest[-1])) if len(digest) else 0
            if size >= TOGETHER and whole:  # the last group may go on
                waiting[-1] = batch.slice(0, whole)
                yield shared_runs(pa.Table.from_batches(waiting), min_chars)
                waiting, size = [batch.slice(whole)], batch.num_rows - whole
        if size:
            yield shared_runs(pa.Table.from_batches(waiting), min_chars)

    return parts.repartition("digest").sortWithinPartitions("digest").mapInArrow(run, _HIT)


Passage = tuple[int, int, int, int, bool]  # start, end, first_id, copies, kept


def resolve(spans: Sequence[tuple[int, int, int, int]], own: int, min_chars: int) -> list[Passage]:
    """The passages of a document by its shared spans (start, end, first_id, copies)."""
    runs: list[list[int]] = []  # first_id, start, end, copies: all windows inside are shared
    for first, start, end, copies in sorted((f, a, b, c) for a, b, f, c in spans):
        if runs and runs[-1][0] == first and start <= runs[-1][2] - min_chars + 1:
            runs[-1][2], runs[-1][3] = max(runs[-1][2], end), max(runs[-1][3], copies)
        else:
            runs.append([first, start, end, copies])
    kept = [r for r in runs if r[0] == own]
    others = sorted((r for r in runs if r[0] != own), key=lambda r: r[1])
    points = sorted({p for r in runs for p in r[1:3]})
    parts: list[list[int]] = []
    heap: list[list[int]] = []
    nth = of_kept = 0
    last = None
    for begin, end in zip(points, points[1:]):
        while nth < len(others) and others[nth][1] <= begin:
            heapq.heappush(heap, others[nth])
            nth += 1
        while heap and heap[0][2] <= begin:
            heapq.heappop(heap)
        while of_kept < len(kept) and kept[of_kept][2] <= begin:
            of_kept += 1
        if not heap or of_kept < len(kept) and kept[of_kept][1] <= begin:
            continue
        if parts and parts[-1][1] == begin and last is heap[0]:
            parts[-1][1] = end
        else:
            parts.append([begin, end, heap[0][0], heap[0][3], *heap[0][1:3]])
        last = heap[0]
    # A short part takes what its run has in the part beside it, if enough is left there; else
    # both are one, if the runs go ``OVERLAP`` characters into each other.
    whole: list[list[int]] = []
    for part in parts:
        if whole and whole[-1][1] == part[0]:
            before = whole[-1]
            room = part[1] - before[0] >= 2 * min_chars
            into = part[4] <= part[0] - OVERLAP or before[5] >= part[0] + OVERLAP
            if part[1] - part[0] < min_chars <= before[1] - before[0]:
                if room and part[4] <= part[1] - min_chars:
                    before[1] = part[0] = part[1] - min_chars
                elif into:
                    before[1], before[5] = part[1], max(before[5], part[5])
                    continue
            elif before[1] - before[0] < min_chars:
                if room and before[5] >= before[0] + min_chars:
                    before[1] = part[0] = before[0] + min_chars
                elif into:
                    part[0], part[4] = whole.pop()[0], min(before[4], part[4])
        whole.append(part)
    return ([(a, b, own, copies, True) for _, a, b, copies in kept]
            + [(a, b, first, copies, False) for a, b, first, copies, *_ in whole if b - a >= min_chars])


def find_repeats(docs: DataFrame, min_chars: int = MIN_CHARS, group: int = GROUP) -> DataFrame:
    """One row per repeated passage: doc_id, node, start and n_chars (characters), first_id
    (of the document that keeps it), copies (most of one anchor), kept."""
    found = anchor_rows(docs, min_chars)  # worked out twice: less than to write and read it
    none = F.lit(_NONE)
    totals = found.groupBy("digest").agg(
        F.count("*").alias("copies"), F.min("node").alias("low"), F.max("node").alias("high"),
        F.min(F.coalesce("doc_id", none)).alias("first_id"),
        (F.min("chunk") != F.max("chunk")).alias("mixed"))
    shared = totals.filter("low != high").select(F.col("digest").alias("__digest"), "copies", "first_id", "mixed")
    repeats = stage_table(found.join(shared, F.col("digest") == F.col("__digest")).drop("__digest"), "repeats")
    mixed = repeats.filter("mixed")
    one = F.min(F.struct("node", "start", "lead", "tail"))
    chunks = stage_table(mixed.groupBy("chunk").agg(
        F.min("digest").alias("digest"), F.min("node").alias("low"), F.max("node").alias("high"),
        F.min(F.coalesce("doc_id", none)).alias("first_id"), one.alias("one")).select("*", "one.*").drop("one"), "chunks")
    crowded = stage_table(chunks.groupBy("digest").agg(F.count("*").alias("n")).filter(F.col("n") > group).select(
        "digest", F.lit(True).alias("crowded")), "crowded")
    chunks = attach(chunks, crowded, ["digest"])
    few = small_groups(chunk_texts(docs, chunks.filter("crowded is null")), min_chars)
    # Anchors of many chunks: a row per window, so that no group is one task's.
    windows = stage_table(chunk_windows(docs, chunks.filter("crowded"), min_chars), "windows")
    held = windows.groupBy(F.col("window").alias("__window")).agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("first_id").alias("held_by"))
    in_chunk = Window.partitionBy("chunk", "held_by").orderBy("at")
    many = (windows.select("chunk", "at", "window")
            .join(held.filter("low != high"), F.col("window") == F.col("__window"))
            .withColumn("run", F.col("at") - F.dense_rank().over(in_chunk))
            .groupBy(F.col("chunk").alias("__chunk"), "held_by", "run")
            .agg(F.min("at").alias("from"), (F.max("at") + min_chars).alias("to")).drop("run"))
    hits = stage_table(few.unionByName(many), "hits")
    span = [F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "first_id", "copies"]
    spans = (repeats.filter("not mixed").select(
        "doc_id", "node", (F.col("start") - F.col("lead")).alias("start"),
        (F.col("start") + F.col("tail")).alias("end"), "first_id", "copies")
        .unionByName(mixed.join(hits, F.col("chunk") == F.col("__chunk")).select(
            "doc_id", "node", (F.col("start") + F.col("from")).alias("start"),
            (F.col("start") + F.col("to")).alias("end"), F.col("held_by").alias("first_id"), "copies")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                doc_ids, nodes = part.column(0).to_pylist(), part.column(1).to_pylist()
                values, stops = part.column(2).flatten(), np.cumsum(part.column(2).value_lengths().to_numpy()).tolist()
                flat = list(zip(*(values.field(n).to_pylist() for n in ("start", "end", "first_id", "copies"))))
                rows = [(doc, node, a, b - a, None if first == _NONE else first, copies, kept)
                        for doc, node, begin, stop in zip(doc_ids, nodes, [0, *stops], stops)
                        for a, b, first, copies, kept in resolve(flat[begin:stop], _NONE if doc is None else doc, min_chars)]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                    names=["doc_id", "node", "start", "n_chars", "first_id", "copies", "kept"])

    return spans.groupBy("doc_id", "node").agg(F.collect_list(F.struct(*span)).alias("spans")).mapInArrow(
        run, "doc_id long, node long, start int, n_chars int, first_id long, copies long, kept boolean")


def remove_repeats(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with their columns, without the passages that another document keeps.
    ``n_chars``, if there, follows."""
    names = docs.columns
    cuts = stage_table(find_repeats(docs, min_chars).filter("not kept").groupBy(F.col("node").alias("__node")).agg(
        F.array_sort(F.collect_list(F.struct("start", F.col("n_chars").alias("length")))).alias("__cuts")), "cuts")
    joined = docs.join(cuts, _node() == F.col("__node"), "left")
    begin = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def step(done: Column, cut: Column) -> Column:
        piece = F.substr(F.col("text"), done["at"] + 1, cut["start"] - done["at"])
        return F.struct(F.concat(done["text"], piece).alias("text"), (cut["start"] + cut["length"]).alias("at"))

    left = F.aggregate("__cuts", begin, step, lambda done: F.concat(done["text"], F.substr(F.col("text"), done["at"] + 1)))
    result = joined.withColumn("text", F.coalesce(left, F.col("text")))
    if "n_chars" in names:
        result = result.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return result.select(*names)
