"""Language-model scoring by deleted interpolation.

The probability of a token is a mixture of maximum-likelihood estimates, of no context (all
tokens alike), of the token, of the token after one before it, and so on up to ``order`` - 1.
The weights depend on the bucket of the context: how long a context was seen in training, and
the power of two of its frequency. A part of the training documents is held out of the counts;
the weights are learned on it by expectation-maximisation. Then its counts are added to the
others', and every document is scored.

Tokens are words, small letters for A-Z, and an end after each document. Counting never lists
tokens as rows: a task makes chunks of its documents, each with the codes of its tokens; a chunk
asks every range of n-gram hashes (64 bits) for the counts of its distinct n-grams, and brings
its own. So a word that is a third of all tokens is one number per chunk. A range's task adds up
the chunks' counts and answers each chunk in the order it asked in. There are never more
questions than n-grams in the corpus, and no table of counts is collected or sent around; the
driver sees sums per bucket only.

Null and empty texts are an end alone. A null id counts as the empty text in the split. Repeated
rows are counted and scored each. Words unseen in training share the estimate of no context.
Without training documents or held-out ones, the weights stay even. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from quotelake.llm.common import ship_package, stage_table
from quotelake.llm.varints import pack, unpack

ORDER = 2
CHUNK_TOKENS = 1 << 22
RANGE_KEYS = 1 << 21     # n-grams asked for in a range of hashes, about
ROUNDS, CLOSE = 25, 1e-3

COUNTED, HELD, SCORED = 0, 1, 2     # roles of documents
HELD_PART = 8                       # one training document of so many is held out

POWERS = 48  # powers of two of a frequency
END, PAD = 0x9E6C63D0876A9A47, 0xD1342543DE82EF95
_ODD = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], dtype=np.uint64)

CHUNK = "chunk long, role int, doc_ids array<long>, lengths array<long>, words binary, codes binary"
ASKED = "chunk long, role int, size int, part long, keys binary, counts binary"
ANSWER = "chunk long, role int, size int, part long, counts binary, counted binary, n long, distinct long, n_counted long, distinct_counted long"
EVIDENCE = "rows binary"
SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def is_held_out(key: str = "doc_id", parts: int = 5, part: int = 1) -> Column:
    """Whether a document is left out of all learning: by the checksum of its id."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts == part


def role_of(key: str = "doc_id", parts: int = 5, part: int = 1) -> Column:
    number = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return (F.when(is_held_out(key, parts, part), SCORED)
            .when(F.floor(number / parts) % HELD_PART == 0, HELD).otherwise(COUNTED))


# ---- chunks

class _Chunk:
    """Documents of one role in the making."""

    def __init__(self) -> None:
        self.words: defaultdict[bytes, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.words[b" "]  # the end: no word has a space
        self.codes, self.lengths, self.ids = array("I"), array("q"), []

    def add(self, doc_id: int | None, text: str | None) -> None:
        before = len(self.codes)
        # Of bytes, only A-Z are made small and only ASCII white space parts words.
        self.codes.extend(map(self.words.__getitem__, (text or "").encode().lower().split()))
        self.codes.append(0)
        self.lengths.append(len(self.codes) - before)
        self.ids.append(doc_id)

    def row(self, number: int, role: int) -> pa.RecordBatch:
        codes = np.frombuffer(self.codes, np.uint32)
        words = np.array([END, *map(xxhash.xxh3_64_intdigest, list(self.words)[1:])], np.uint64)
        # Codes by frequency: the commonest words take the fewest bytes.
        order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        values = (number, role, self.ids, self.lengths.tolist(), words[order].tobytes(), pack(rank[codes])[0].tobytes())
        kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)],
                                          names=["chunk", "role", "doc_ids", "lengths", "words", "codes"])


def chunks(docs: DataFrame, role: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The staged chunks of the documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, open_ = TaskContext.get().partitionId() << 32, {r: _Chunk() for r in (COUNTED, HELD, SCORED)}
        for batch in batches:
            for doc_id, kind, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                chunk = open_[kind]
                chunk.add(doc_id, value.as_py())
                if len(chunk.codes) >= CHUNK_TOKENS:
                    yield chunk.row(number, kind)
                    number, open_[kind] = number + 1, _Chunk()
        for kind, chunk in open_.items():
            if chunk.ids:
                yield chunk.row(number, kind)
                number += 1

    ship_package(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), role.cast("int").alias("role"), F.col(text).alias("text"))
    return stage_table(rows.mapInArrow(run, CHUNK), "chunks", compression="zstd")


def grams(words: np.ndarray, codes: np.ndarray, lengths: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the n-grams that end at each token, for each size up to ``order``; contexts
    that reach beyond a document's start are filled up."""
    first = np.cumsum(lengths) - lengths
    sizes = [words[codes]]
    for size in range(2, order + 1):
        before = np.roll(sizes[-1], 1)
        before[first] = PAD + size
        keys = (before * _ODD[0]) ^ sizes[0]
        keys = (keys ^ (keys >> np.uint64(29))) * _ODD[1]
        sizes.append(keys ^ (keys >> np.uint64(32)))
    return sizes


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, codes and document lengths of a chunk."""
    return (np.frombuffer(row["words"], np.uint64), unpack(np.frombuffer(row["codes"], np.uint8)),
            np.array(row["lengths"], np.int64))


# ---- counts

def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as gaps, byte by byte: the high bytes of gaps are zeros, which compress."""
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return gaps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").reshape(-1), dtype=np.uint64)


def _asked(rows: DataFrame, order: int, bits: int) -> DataFrame:
    """Each chunk's distinct n-grams with its counts, cut by ranges of their hashes."""
    shift = np.uint64(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for size, found in enumerate(grams(*_open(row), order), 1):
                    keys, counts = np.unique(found, return_counts=True)
                    part = (keys >> shift).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                    cuts = np.flatnonzero(np.diff(part, prepend=-1))
                    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)]):
                        own = pack(counts[a:b])[0].tobytes() if row["role"] != SCORED else b""
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([v], k) for v, k in zip(
                                (row["chunk"], row["role"], size, int(part[a]), pack_keys(keys[a:b]), own),
                                (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                            names=["chunk", "role", "size", "part", "keys", "counts"])

    return rows.mapInArrow(run, ASKED)


_ANSWER_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4)
_ANSWER_NAMES = [field.split()[0] for field in ANSWER.split(", ")]


def _answer_range(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    """Answers to the chunks' questions about one range: counts in all training documents, for
    held-out chunks those without the held-out part too. The first has the range's sums."""
    keys = [unpack_keys(r["keys"]) for r in rows]
    ends = np.cumsum([len(k) for k in keys])
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    del keys
    sums = np.zeros((2, len(found)), np.int64)  # counted, held
    for row, end, start in zip(rows, ends, [0, *ends[:-1]]):
        if row["role"] != SCORED:  # a chunk asks for an n-gram once
            sums[row["role"], place[start:end]] += unpack(np.frombuffer(row["counts"], np.uint8))
    full = sums.sum(axis=0)
    totals = (int(full.sum()), int((full > 0).sum()), int(sums[0].sum()), int((sums[0] > 0).sum()))
    for row, end, start in zip(rows, ends, [0, *ends[:-1]]):
        at = place[start:end]
        counted = pack(sums[0, at])[0].tobytes() if row["role"] == HELD else b""
        values = (row["chunk"], row["role"], row["size"], row["part"], pack(full[at])[0].tobytes(), counted, *totals)
        totals = (0, 0, 0, 0)
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, _ANSWER_TYPES)], names=_ANSWER_NAMES)


def _answers(rows: DataFrame, order: int) -> DataFrame:
    """The staged answers to all chunks."""
    tokens = rows.select(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, tokens) / RANGE_KEYS))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if waiting and (row["size"], row["part"]) != (waiting[0]["size"], waiting[0]["part"]):
                    yield from _answer_range(waiting)
                    waiting = []
                waiting.append(row)
        if waiting:
            yield from _answer_range(waiting)

    asked = _asked(rows, order, bits).repartition("size", "part").sortWithinPartitions("size", "part", "chunk")
    return stage_table(asked.mapInArrow(run, ANSWER), "answers")


# ---- weights

def _counts(row: dict, answers: pa.Table, column: str, order: int, n_docs: int) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """For each size: the n-gram's hash, its count and its context's, at each token of a chunk."""
    words, codes, lengths = _open(row)
    first = np.cumsum(lengths) - lengths
    hashes, counts, contexts = grams(words, codes, lengths, order), [], []
    for size, found in enumerate(hashes, 1):
        own = answers.filter(pc.equal(answers["size"], size)).sort_by("part")
        numbers = np.concatenate([unpack(np.frombuffer(b, np.uint8)) for b in own[column].to_pylist()])
        counts.append(numbers[np.unique(found, return_inverse=True)[1]])
        if size > 1:
            before = np.roll(counts[-2], 1)
            before[first] = n_docs
            contexts.append(before)
    return hashes, counts, contexts


def bucket_of(contexts: list[np.ndarray], n: int) -> np.ndarray:
    """The bucket of each token's context: the longest one seen, and the power of two of its frequency."""
    bucket = np.zeros(n, np.int64)
    for size, seen in enumerate(contexts, 1):
        power = np.frexp(np.maximum(seen, 1).astype(np.float64))[1] - 1
        bucket = np.where(seen > 0, size * POWERS + np.minimum(power, POWERS - 1), bucket)
    return bucket


def estimates(counts: list[np.ndarray], contexts: list[np.ndarray], n: int, distinct: int) -> np.ndarray:
    """A row per token: the estimates of no context, of the token, of longer contexts."""
    columns = [np.full(len(counts[0]), 1 / (distinct + 1)), counts[0] / max(n, 1)]
    columns += [c / np.maximum(s, 1) for c, s in zip(counts[1:], contexts)]
    return np.stack(columns, axis=1)


def even_weights(order: int) -> np.ndarray:
    """Weights by bucket: even over no context, the token, and the contexts seen."""
    known = np.arange(order * POWERS) // POWERS + 1
    mask = np.arange(order + 1)[None, :] <= known[:, None]
    return mask / mask.sum(axis=1, keepdims=True)


def _evidence(rows: DataFrame, answers: DataFrame, order: int, n_docs: int) -> DataFrame:
    """The distinct n-grams of the held-out chunks, staged: how often each stands, then the
    counts without the held-out part of its token, of the longer n-grams and their contexts."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = left.to_pylist()
        hashes, counts, contexts = _counts(row, right, "counted", order, n_docs)
        _, at, weight = np.unique(hashes[-1], return_index=True, return_counts=True)
        values = np.stack([weight, *(c[at] for c in (*counts, *contexts))], axis=1)
        return pa.table({"rows": pa.array([pack(values.reshape(-1))[0].tobytes()], pa.binary())})

    held = rows.filter(F.col("role") == HELD).groupBy("chunk")
    told = answers.filter(F.col("role") == HELD).select("chunk", "size", "part", "counted").groupBy("chunk")
    return stage_table(held.cogroup(told).applyInArrow(run, EVIDENCE), "evidence")


def learn_weights(evidence: DataFrame, order: int, n: int, distinct: int) -> np.ndarray:
    """Mixture weights by bucket, by expectation-maximisation over the evidence."""
    weights = even_weights(order)
    sums = ", ".join(f"s{k} double" for k in range(order + 1))
    for _ in range(ROUNDS):
        def expect(batches: Iterator[pa.RecordBatch], now: np.ndarray = weights) -> Iterator[pa.RecordBatch]:
            total = np.zeros((order * POWERS, order + 1))
            for batch in batches:
                for data in batch.column(0).to_pylist():
                    values = unpack(np.frombuffer(data, np.uint8)).reshape(-1, 2 * order).T
                    counts, contexts = list(values[1:order + 1]), list(values[order + 1:])
                    bucket = bucket_of(contexts, values.shape[1])
                    shares = now[bucket] * estimates(counts, contexts, n, distinct)
                    shares *= (values[0] / shares.sum(axis=1))[:, None]
                    for k in range(order + 1):
                        total[:, k] += np.bincount(bucket, shares[:, k], order * POWERS)
            used = np.flatnonzero(total.sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(total[used, k]) for k in range(order + 1))],
                                             names=["bucket", *(f"s{k}" for k in range(order + 1))])

        found = (evidence.mapInArrow(expect, f"bucket long, {sums}").groupBy("bucket")
                 .agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(order + 1))).collect())
        before, prior = weights, even_weights(order)
        weights = prior.copy()
        for row in found:
            share = np.array(row[1:]) + prior[row.bucket]  # one token more, shared evenly: no weight is ever none
            weights[row.bucket] = share / share.sum()
        if np.abs(weights - before).max() < CLOSE:
            break
    return weights


# ---- scores

def score(docs: DataFrame, role: Column | None = None, order: int = ORDER, text: str = "text",
          key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    ``base_score`` is that of the tokens alone, half a count added to each; both are log10.
    """
    rows = chunks(docs, role_of(key) if role is None else role, text, key)
    answers = _answers(rows, order)
    sums = answers.filter("size = 1").agg(*(F.sum(c).alias(c) for c in ("n", "distinct", "n_counted", "distinct_counted"))).first()
    n, distinct, n_counted, distinct_counted = (x or 0 for x in sums)
    docs_by_role = {r.role: r.n for r in rows.groupBy("role").agg(F.sum(F.size("doc_ids")).alias("n")).collect()}
    n_docs = docs_by_role.get(COUNTED, 0) + docs_by_role.get(HELD, 0)
    evidence = _evidence(rows, answers, order, docs_by_role.get(COUNTED, 0))
    weights = learn_weights(evidence, order, n_counted, distinct_counted)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = left.to_pylist()
        lengths = np.array(row["lengths"], np.int64)
        first = np.cumsum(lengths) - lengths
        _, counts, contexts = _counts(row, right, "counts", order, n_docs)
        mixed = (weights[bucket_of(contexts, len(counts[0]))] * estimates(counts, contexts, n, distinct)).sum(axis=1)
        base = np.log10((counts[0] + 0.5) / (n + 0.5 * (distinct + 1)))
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(np.full(len(lengths), row["role"] == SCORED)),
            "n_tokens": pa.array(lengths), "n_known": pa.array(np.add.reduceat((counts[0] > 0).astype(np.int64), first)),
            "base_score": pa.array(np.add.reduceat(base, first)), "score": pa.array(np.add.reduceat(np.log10(mixed), first))})

    told = answers.select("chunk", "size", "part", "counts").groupBy("chunk")
    scored = rows.groupBy("chunk").cogroup(told).applyInArrow(run, SCORE)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
