"""Token-ID output: documents as token ids in a compact binary format, and back.

Ids are replaced by their rank by frequency, so that common ids take one byte, and written
in byte-aligned variable-length coding with separate control bytes: two bits per id say
whether it has 1 to 4 bytes, four ids share a control byte, and the ids' bytes follow apart.
A document is a record (doc_id, n_tokens, control, data); decoding looks control bytes up in
a numpy table. Records lie in Parquet files in ascending doc_id order, null first, one file
per range of ids, written by Spark's committer, so a lost executor only repeats its tasks.
The table of ids by rank is beside the records.

The texts are encoded once, into a staged table of fixed-width ids; counting and writing
read that. Memory is bounded by slices of ``SLICE_BYTES`` of text, or the longest text. Rows
of one doc_id share a file and follow in order of their ids.

The tokenizer must drop white space, so that words can be encoded apart and remembered.
Null and empty texts have the end id alone; repeated rows are records of their own; an empty
table gives no records; other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quotelake.llm.common import attach, ship_package, stage_table
from quotelake.llm.text_slices import slices
from quotelake.sources.workdir import new_workdir

MEMORY_WORDS = 400_000
WORDS_PER_CALL = 512

RECORD = "doc_id long, file int, n_tokens long, start long, control binary, data binary"

# Per control byte, the lengths of its four ids.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1


@dataclass
class TokenFiles:
    """Folders of the records and of the table of ids by rank."""

    records: str
    ranks: str


# Signs but for the apostrophe, and letters whose small forms are letters again: the
# tokenizer takes a word of such letters apart from the signs that follow.
FILE_TOKENS = 1 << 26
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
SIMPLE = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+[!-&(-/:-@\[-`{-~]*$"
LETTERS = re.compile("[a-zß-öø-ÿ]+")


def _joined(runs: np.ndarray, ends: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs at all places, one after another, and where each ends; run i is from
    ``ends[i]`` to ``ends[i + 1]``."""
    begins, counts = ends[places], ends[places + 1] - ends[places]
    sums = np.cumsum(counts)
    return runs[np.repeat(begins - sums + counts, counts) + np.arange(sums[-1] if len(sums) else 0)], sums


class WordEncoder:
    """Encodes texts word by word and remembers words; one per Python worker.

    Words are remembered as their letters in small form; the signs at their end are words of
    their own. Many letter words are encoded in one call, with spaces between: each gives
    one run of ids that closes with a token of a word's end.
    """

    _made: dict[str, WordEncoder] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        """Place 0 is the empty word."""
        self.words: dict[str, int] = {"": 0}
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.ends = np.zeros(2, dtype=np.int64)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, dtype=np.uint32) for c in coded]

    def _learn(self, new: list[str]) -> None:
        letters = [w for w in new if LETTERS.fullmatch(w)]
        others = [w for w in new if not LETTERS.fullmatch(w)]
        runs, ends, names = [], [], []
        used = int(self.ends[-1])
        groups = [letters[i:i + WORDS_PER_CALL] for i in range(0, len(letters), WORDS_PER_CALL)]
        for group, ids in zip(groups, self._encode([" ".join(g) for g in groups])):
            stops = np.flatnonzero(self.closes[ids]) + 1
            if len(stops) == len(group):
                runs.append(ids)
                ends.append(used + stops)
                names += group
                used += len(ids)
            else:
                others += group
        for name, ids in zip(others, self._encode(others)):
            runs.append(ids)
            used += len(ids)
            ends.append(np.array([used]))
            names.append(name)
        if used > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(used, dtype=np.uint32)))
        if runs:
            self.ids[int(self.ends[-1]):used] = np.concatenate(runs)
        first = len(self.ends) - 1
        self.ends = np.concatenate((self.ends, *ends))
        self.words.update(zip(names, range(first, first + len(names))))

    def _places(self, words: list[str]) -> np.ndarray:
        places = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(places < 0).tolist()
        if unknown:
            new = [words[i] for i in unknown]
            self._learn(list(dict.fromkeys(new)))
            places[unknown] = np.fromiter(map(self.words.__getitem__, new), np.int64, len(new))
        return places

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text closed by ``end_id``, and where each text ends."""
        if len(self.words) > MEMORY_WORDS:
            self.forget()
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary
        simple = pc.match_substring_regex(words, SIMPLE)
        small = pc.utf8_lower(words)
        stems = pc.if_else(simple, pc.utf8_rtrim(small, characters=SIGNS), words)
        stem = stems.dictionary_encode()
        parts = np.zeros(2 * len(words), dtype=np.int64)
        parts[::2] = self._places(stem.dictionary.to_pylist())[stem.indices.to_numpy()]
        cut = (pc.binary_length(small).to_numpy() - pc.binary_length(stems).to_numpy()) * simple.to_numpy(zero_copy_only=False)
        signed = np.flatnonzero(cut)
        tails = [w[-n:] for w, n in zip(words.take(pa.array(signed)).to_pylist(), cut[signed].tolist())]
        parts[2 * signed + 1] = self._places(tails)
        own, ends = _joined(self.ids, self.ends, parts)
        ids, sums = _joined(own, np.concatenate(([0], ends[1::2])), coded.indices.to_numpy())
        stops = np.concatenate(([0], sums))[np.cumsum(pc.list_value_length(split).to_numpy())]
        return np.insert(ids, stops, end_id), stops + np.arange(1, len(stops) + 1)


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def pack(values: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Control and data bytes of each run of values; runs end at ``ends``."""
    begins = np.concatenate(([0], ends[:-1]))
    counts = ends - begins
    extra = (values > 0xFF).astype(np.int64) + (values > 0xFFFF) + (values > 0xFFFFFF)
    wide = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = wide[np.arange(4) <= extra[:, None]]
    data_ends = np.concatenate(([0], np.cumsum(extra + 1)))[ends]
    control_ends = np.cumsum((counts + 3) // 4)
    control_begins = control_ends - (counts + 3) // 4
    codes = np.zeros(4 * (int(control_ends[-1]) if len(ends) else 0), dtype=np.uint8)
    codes[np.arange(len(values)) + np.repeat(4 * control_begins - begins, counts)] = extra
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    return _binary(control, control_ends), _binary(data, data_ends)


def _bytes(column: pa.Array) -> np.ndarray:
    joined = b"".join(x.as_py() for x in column)
    return np.frombuffer(joined, dtype=np.uint8)


def unpack(control: pa.Array, data: pa.Array, counts: np.ndarray) -> np.ndarray:
    """The values of all records, one after another; ``counts`` are the records' lengths."""
    lengths = LENGTHS[_bytes(control)].reshape(-1)
    slots = (counts + 3) // 4 * 4
    place = np.arange(len(lengths)) - np.repeat(np.cumsum(slots) - slots, slots)
    lengths = lengths[place < np.repeat(counts, slots)]
    raw = np.concatenate((_bytes(data), np.zeros(3, dtype=np.uint8))).astype(np.uint32)
    at = np.cumsum(lengths) - lengths
    values = raw[at]
    for k in range(1, 4):
        more = np.flatnonzero(lengths > k)
        values[more] |= raw[at[more] + k] << np.uint32(8 * k)
    return values


def id_type(tokenizer: str, end_id: int) -> str:
    """Little-endian numbers wide enough for all ids."""
    from tokenizers import Tokenizer
    largest = max(end_id, *Tokenizer.from_file(tokenizer).get_vocab().values())
    return "<u2" if largest < 1 << 16 else "<u4"


def encoded(docs: DataFrame, tokenizer: str, end_id: int, kind: str) -> DataFrame:
    """doc_id and the ids of every document, as bytes of numbers of ``kind``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                ids, ends = WordEncoder.of(tokenizer).encode(part.column(1), end_id)
                raw = ids.astype(kind)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _binary(raw.view(np.uint8), ends * raw.itemsize)], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")


def id_ranks(ids: DataFrame, kind: str) -> DataFrame:
    """id, n and rank of every id; the most frequent has rank 0, ties by id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                counts = np.bincount(_bytes(part.column(0)).view(kind), minlength=len(total))
                counts[:len(total)] += total
                total = counts
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], names=["id", "n"])

    counted = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # At most as many rows as the vocabulary.
    order = Window.orderBy(F.desc("n"), "id")
    return stage_table(counted.withColumn("rank", F.row_number().over(order) - 1), "ranks")


def _file_bounds(docs: DataFrame, files: int) -> np.ndarray:
    cuts = docs.approxQuantile("doc_id", [i / files for i in range(1, files)], 0.5 / files) if files > 1 else []
    return np.array(sorted(set(cuts)), dtype=np.float64)


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, files: int | None = None) -> TokenFiles:
    """Encode the documents and write the records, by default to files of ``FILE_TOKENS`` at most, about."""
    spark = docs.sparkSession
    ship_package(spark)
    kind = id_type(tokenizer, end_id)
    staged = stage_table(encoded(docs, tokenizer, end_id, kind), "token-ids", compression="zstd")
    ranked = id_ranks(staged, kind)
    table = ranked.toPandas()  # bounded by the vocabulary
    if not files:
        files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(table["n"].sum()) // FILE_TOKENS))
    rank_of = np.zeros(int(table["id"].max()) + 1 if len(table) else 1, dtype=np.uint32)
    rank_of[table["id"].to_numpy()] = table["rank"].to_numpy()
    bounds = _file_bounds(staged, files)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                sizes = pc.binary_length(part.column(1)).to_numpy().astype(np.int64) // np.dtype(kind).itemsize
                ends = np.cumsum(sizes)
                control, data = pack(rank_of[_bytes(part.column(1)).view(kind)], ends)
                doc_id = part.column(0)
                file = np.searchsorted(bounds, pc.fill_null(doc_id, np.iinfo(np.int64).min).to_numpy(), side="left")
                yield pa.RecordBatch.from_arrays(
                    [doc_id, pa.array(file, pa.int32()), pa.array(sizes, pa.int64()), control, data],
                    names=["doc_id", "file", "n_tokens", "control", "data"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            counts = batch.column(2).to_numpy()
            sums = np.cumsum(counts) + done
            done = int(sums[-1]) if len(sums) else done
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums - counts, pa.int64()), *batch.columns[3:]],
                names=["doc_id", "file", "n_tokens", "start", "control", "data"])

    records = staged.mapInArrow(coded, "doc_id long, file int, n_tokens long, control binary, data binary")
    ordered = records.repartitionById(files, "file").sortWithinPartitions("doc_id", "n_tokens", "control", "data")
    path = new_workdir(spark, "token-files")
    ordered.mapInArrow(place, RECORD).write.parquet(path)
    ranks = new_workdir(spark, "token-ranks")
    ranked.write.parquet(ranks)
    return TokenFiles(path, ranks)


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """Records with ``start``, the number of ids of all documents before."""
    records = spark.read.schema(RECORD).parquet(files.records)
    totals = records.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    offsets = stage_table(totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before")), "offsets")
    return attach(records, offsets, ["file"]).withColumn("start", F.col("start") + F.col("before")).drop("before", "file")


def token_digests(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian 32-bit integers),
    from the ids read back."""
    ship_package(spark)
    table = spark.read.parquet(files.ranks).toPandas()  # bounded by the vocabulary
    id_of = np.zeros(len(table) or 1, dtype="<u4")
    id_of[table["rank"].to_numpy()] = table["id"].to_numpy()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 4):
                counts = part.column(2).to_numpy()
                ids = memoryview(id_of[unpack(part.column(3), part.column(4), counts)].view(np.uint8))
                ends = 4 * np.cumsum(counts)
                crc = [zlib.crc32(ids[e - 4 * n:e]) for n, e in zip(counts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    records = read_token_files(spark, files).select("doc_id", "start", "n_tokens", "control", "data")
    return records.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
