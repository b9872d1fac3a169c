"""Ranked lexical search: an index in segments and Block-Max MaxScore over it.

**Index.** A task cuts its documents, in the order it reads them, into segments of a bounded
number of postings. A segment has a row of its documents (ids and lengths) and a row per term:
the postings in blocks of ``BLOCK``, gaps of document numbers and frequencies in bytes of seven
bits, and for each block its last document and its impacts, the pairs of frequency and length
that no other pair of the block beats. Impacts bound a block's scores for any corpus-wide
figures, so the index is made in one pass and more segments can be added.

**Search.** Document frequencies come from the index. For a segment and an item, the lists are
ordered by their greatest score; those that together stay below the item's k-th score so far are
not essential: only documents of the others are scored. A candidate then meets the remaining
lists from the greatest down, first by the maximum of the one block that can hold it; a block is
unpacked only if a candidate's bound still reaches the k-th score. The heap of an item goes on
from segment to segment of a task, so its bound rises; the tasks' heaps are merged by a rank per
item. Scores are whole numbers and bounds exact, so nothing that ranks is left out.

Items are queries given beforehand: they are answered in blocks of bounded size, each against
the whole index. An item is an id and a text; repeated rows of it are one item, a null id or
text is allowed, one without a term has no result. Documents without a term, null texts too,
are not counted and never found. Repeated document rows are documents each; null ids rank after
the others of equal score. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from quotelake.llm.common import BROADCAST_BYTES, ship_package, stage_table, table_bytes
from quotelake.llm.varints import pack, unpack

# Terms: runs of anything but ASCII characters that are no letters or digits.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BLOCK = 128
SEGMENT_POSTINGS = 3_000_000
SEGMENT_DOCUMENTS = 1 << 17
ROWS_OUT = 20_000        # index rows that leave a task at once
WINDOW = 1 << 13         # documents scored at once
ITEM_TERMS = 50_000      # pairs of item and term in a block of items, about
TOP = 50

_PLAIN = bytes(ord(chr(b).lower()) if chr(b).isalnum() or b > 127 else 32 for b in range(128)) + bytes(range(128, 256))

INDEX = "segment long, term string, df long, total long, blocks binary, postings binary"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order."""
    return (text or "").encode().translate(_PLAIN).split()


def sql_terms(text: Column) -> Column:
    """The terms of a text, in order."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(plain, F.lit(TERM), F.lit(0))


def skyline(block: np.ndarray, tf: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block, frequency and length of the pairs that no pair of their block beats.

    Blocks come ascending; a pair beats another by a frequency as high in a text as short.
    """
    order = np.lexsort((length, -tf, block))
    block, tf, length = block[order], tf[order], length[order]
    # Ascending minimum per block: blocks are set apart by more than any length.
    apart = block * (int(length.max(initial=0)) + 1)
    least = np.minimum.accumulate(length - apart)
    kept = np.concatenate(([True], least[1:] < least[:-1])) if len(block) else np.zeros(0, bool)
    return block[kept], tf[kept], length[kept]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each pair of start and size, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(starts, sizes)


def _binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


class _Segment:
    """Documents and postings of a segment in the making."""

    def __init__(self) -> None:
        self.terms: defaultdict[bytes, int] = defaultdict()
        self.terms.default_factory = self.terms.__len__
        self.ids: list[int | None] = []
        self.lengths, self.distinct = array("q"), array("q")
        self.term, self.tf = array("q"), array("q")

    def add(self, doc_id: int | None, text: str | None) -> None:
        found = terms_of(text)
        if found:
            counts = Counter(found)
            self.ids.append(doc_id)
            self.lengths.append(len(found))
            self.distinct.append(len(counts))
            self.term.extend(map(self.terms.__getitem__, counts))
            self.tf.extend(counts.values())

    def full(self) -> bool:
        return len(self.term) >= SEGMENT_POSTINGS or len(self.ids) >= SEGMENT_DOCUMENTS

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        """The segment's index rows: that of its documents first."""
        lengths = np.frombuffer(self.lengths, np.int64)
        ids = pa.array(self.ids, pa.int64())
        known = np.array([i is not None for i in self.ids])
        yield _index_rows(number, pa.array([None], pa.string()), np.array([len(lengths)]), lengths.sum(keepdims=True),
                          pa.array([lengths.tobytes() + known.tobytes()], pa.binary()),
                          pa.array([ids.fill_null(0).to_numpy().tobytes()], pa.binary()))

        term, tf = np.frombuffer(self.term, np.int64), np.frombuffer(self.tf, np.int64)
        doc = np.repeat(np.arange(len(lengths)), np.frombuffer(self.distinct, np.int64))
        order = np.argsort(term, kind="stable")
        term, tf, doc = term[order], tf[order], doc[order]
        df = np.bincount(term, minlength=len(self.terms))
        first = np.cumsum(df) - df
        # Blocks of each term; the number of each posting's block over the whole segment.
        blocks = -(-df // BLOCK)
        block = np.repeat(np.cumsum(blocks) - blocks, df) + (np.arange(len(doc)) - np.repeat(first, df)) // BLOCK
        last = np.flatnonzero(np.append(np.diff(block) != 0, True))
        new_term = np.zeros(len(doc), bool)
        new_term[first] = True
        gaps = np.where(new_term, doc, doc - np.concatenate(([0], doc[:-1])) - 1)
        data, sizes = pack(np.stack((gaps, tf), axis=1).reshape(-1))
        sizes = sizes.reshape(-1, 2).sum(axis=1)
        term_bytes = np.add.reduceat(sizes, first)
        at = np.cumsum(sizes) - sizes
        block_first = np.concatenate(([0], last[:-1] + 1))
        block_term = term[block_first]
        begin = at[block_first] - at[first][block_term]
        sky_block, sky_tf, sky_n = skyline(block, tf, lengths[doc])
        pairs = np.bincount(sky_block, minlength=len(last))

        # Header of a term: last, begin and pairs of its blocks, then the pairs.
        term_pairs = np.bincount(block_term, pairs, len(self.terms)).astype(np.int64)
        words = 3 * blocks + 2 * term_pairs
        start = np.cumsum(words) - words
        header = np.zeros(int(words.sum()), np.uint32)
        for k, values in enumerate((doc[last], begin, pairs)):
            header[_ranges(start + k * blocks, blocks)] = values
        for k, values in enumerate((sky_tf, sky_n)):
            header[_ranges(start + 3 * blocks + k * term_pairs, term_pairs)] = values
        total = np.add.reduceat(tf, first)
        names = pa.array([t.decode() for t in self.terms], pa.string())
        headers = _binaries(header.view(np.uint8), 4 * words)
        postings = _binaries(data, term_bytes)
        for i in range(0, len(df), ROWS_OUT):
            part = slice(i, i + ROWS_OUT)
            yield _index_rows(number, names[part], df[part], total[part], headers[part], postings[part])


def _index_rows(number: int, names: pa.Array, df: np.ndarray, total: np.ndarray, blocks: pa.Array,
                postings: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(names), number)), names, pa.array(df, pa.int64()), pa.array(total, pa.int64()), blocks, postings],
        names=["segment", "term", "df", "total", "blocks", "postings"])


def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The staged index of the documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, segment = TaskContext.get().partitionId() << 32, _Segment()
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                segment.add(doc_id, value.as_py())
                if segment.full():
                    yield from segment.rows(number)
                    number, segment = number + 1, _Segment()
        if segment.ids:
            yield from segment.rows(number)

    ship_package(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return stage_table(rows.mapInArrow(run, INDEX), "lexical-index")


def term_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of a score, before its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class _List:
    """Postings of a term in a segment."""

    def __init__(self, df: int, blocks: bytes, postings: bytes, relative) -> None:
        header = np.frombuffer(blocks, np.uint32).astype(np.int64)
        n = -(-df // BLOCK)
        self.last, begin, pairs = header[:n], header[n:2 * n], header[2 * n:3 * n]
        self.ends = np.append(begin, len(postings))
        tf, length = header[3 * n:].reshape(2, -1)
        self.most = np.maximum.reduceat(term_score(tf, relative(length)), np.cumsum(pairs) - pairs)
        self.peak = int(self.most.max())
        self.data = np.frombuffer(postings, np.uint8)

    def read(self, first: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and frequencies of neighbouring blocks."""
        values = unpack(self.data[self.ends[first]:self.ends[stop]]).reshape(-1, 2)
        before = int(self.last[first - 1]) if first else -1
        return before + np.cumsum(values[:, 0] + 1), values[:, 1]


class _Heap:
    """The best documents of an item so far: by score, then by id, null ids last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score, self.ids, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """The score that a further document needs at least."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        score, ids, known = (np.concatenate(x) for x in ((self.score, score), (self.ids, ids), (self.known, known)))
        best = np.lexsort((ids, ~known, -score))[:self.k]
        self.score, self.ids, self.known = score[best], ids[best], known[best]


def _search_segment(heap: _Heap, lists: list[tuple[int, _List]], m: np.ndarray, ids: np.ndarray, known: np.ndarray) -> int:
    """Add the segment's best documents to the heap; how many blocks were unpacked."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].peak)
    bounds = np.cumsum([w * x.peak for w, x in lists])
    opened = 0
    for start in range(0, len(m), WINDOW):
        stop = min(start + WINDOW, len(m))
        essential = int(np.searchsorted(bounds, heap.least))
        if essential == len(lists):
            break
        total = np.zeros(stop - start, np.int64)
        for weight, postings in lists[essential:]:
            first, after = np.searchsorted(postings.last, (start, stop - 1))
            after = min(int(after) + 1, len(postings.last))
            if first >= after:
                continue
            doc, tf = postings.read(int(first), after)
            opened += after - int(first)
            inside = slice(*np.searchsorted(doc, (start, stop)))
            doc, tf = doc[inside], tf[inside]
            total[doc - start] += weight * term_score(tf, m[doc])
        doc = np.flatnonzero(total)
        score, doc = total[doc], doc + start
        for i in range(essential - 1, -1, -1):
            weight, postings = lists[i]
            below = int(bounds[i - 1]) if i else 0
            block = np.searchsorted(postings.last, doc)
            most = weight * np.append(postings.most, 0)[block]
            alive = score + most + below >= heap.least
            doc, score, block = doc[alive], score[alive], block[alive]
            wanted = np.unique(block[block < len(postings.last)])
            for run in np.split(wanted, np.flatnonzero(np.diff(wanted) != 1) + 1) if len(wanted) else []:
                held, tf = postings.read(int(run[0]), int(run[-1]) + 1)
                opened += len(run)
                at = np.minimum(np.searchsorted(held, doc), len(held) - 1)
                hit = held[at] == doc
                score[hit] += weight * term_score(tf[at[hit]], m[doc[hit]])
        alive = score >= heap.least
        doc, score = doc[alive], score[alive]
        if len(doc):
            heap.add(score, ids[doc], known[doc])
    return opened


Items = list[tuple[int, list[tuple[str, int]]]]


def _search(batches: Iterable[pa.RecordBatch], items: Items, n_docs: int, n_terms: int, k: int) -> Iterator[pa.RecordBatch]:
    """The best documents of each item over the segments of a task, which come one after the other."""
    heaps = {item: _Heap(k) for item, _ in items}

    def relative(length: np.ndarray) -> np.ndarray:
        return 100 - 50 + (50 * length * n_docs) // n_terms

    def close(documents: tuple[bytes, bytes], rows: dict[str, tuple]) -> None:
        count = len(documents[1]) // 8
        ids = np.frombuffer(documents[1], np.int64)
        m = relative(np.frombuffer(documents[0], np.int64, count))
        known = np.frombuffer(documents[0], bool, offset=8 * count)
        lists: dict[str, _List] = {}
        for item, terms in items:
            chosen = []
            for term, weight in terms:
                if term in rows and weight > 0:
                    if term not in lists:
                        lists[term] = _List(*rows[term], relative)
                    chosen.append((weight, lists[term]))
            if chosen:
                _search_segment(heaps[item], chosen, m, ids, known)

    segment, documents, rows = None, None, {}
    for batch in batches:
        for number, term, df, _, blocks, postings in zip(*(c.to_pylist() for c in batch.columns)):
            if number != segment:
                if documents and rows:
                    close(documents, rows)
                segment, documents, rows = number, None, {}
            if term is None:
                documents = (blocks, postings)
            else:
                rows[term] = (df, blocks, postings)
    if documents and rows:
        close(documents, rows)
    for item, heap in heaps.items():
        if len(heap.score):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(heap.score), item)), pa.array(heap.ids, mask=~heap.known), pa.array(heap.score)],
                names=["item", "doc_id", "score"])


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if table_bytes(df) <= BROADCAST_BYTES else df


def search(index: DataFrame, items: DataFrame, k: int = TOP, text: str = "text", key: str = "item_id") -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``k`` best documents in a staged index."""
    spark = index.sparkSession
    ship_package(spark)
    item = F.xxhash64(F.to_json(F.struct(F.col(key).alias("a"), F.col(text).alias("b"))))
    named = stage_table(items.select(item.alias("item"), F.col(key).alias("item_id"), F.col(text).alias("text")).distinct(), "items")
    pairs = stage_table(named.select("item", F.explode(F.array_distinct(sql_terms(F.col("text")))).alias("term")), "item-terms")
    size = index.filter("term is null").agg(F.sum("df").alias("docs"), F.sum("total").alias("terms")).first()
    n_blocks = -(-pairs.count() // ITEM_TERMS) if size.docs else 0
    found = None
    for block in range(n_blocks):
        chosen = pairs.filter(F.pmod("item", F.lit(n_blocks)) == block)
        best = _search_block(index, chosen, size.docs, size.terms, k)
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = spark.range(0).select(*(F.lit(None).cast("long").alias(c) for c in ("item", "doc_id", "score")))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = named.select(F.col("item").alias("__item"), "item_id")
    return ranked.join(_small(names), F.col("item") == F.col("__item")).select("item_id", "rank", "doc_id", "score")


def _search_block(index: DataFrame, pairs: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best documents of each task for a block of items; its terms are few enough to send around."""
    terms = F.broadcast(stage_table(pairs.select(F.col("term").alias("wanted")).distinct(), "wanted"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.sum("df") + 1))).cast("long")
    weights = index.join(terms, F.col("term") == F.col("wanted")).groupBy("term").agg(weight.alias("weight"))
    items: dict[int, list[tuple[str, int]]] = defaultdict(list)
    for row in pairs.join(stage_table(weights, "weights"), "term").select("item", "term", "weight").collect():
        items[row.item].append((row.term, row.weight))
    sent = index.sparkSession.sparkContext.broadcast(list(items.items()))
    rows = (index.join(terms, F.col("term") == F.col("wanted"), "left").filter("term is null or wanted is not null")
            .drop("wanted").repartition("segment").sortWithinPartitions("segment", F.asc_nulls_first("term")))
    return rows.mapInArrow(lambda batches: _search(batches, sent.value, n_docs, n_terms, k),
                           "item long, doc_id long, score long")
