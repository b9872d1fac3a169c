"""Quality rules: rules per document, and a verdict per host from how often its documents fail.

The rules run in Arrow batches, a text at a time, so memory follows the longest text. The
failures are summed by host before the shuffle; each host's rate is shrunk by a beta prior
fitted to all hosts; a host whose rate is above the limit with confidence takes all its
documents with it. Null and empty texts have no word and fail; a null host is a host of its
own; repeated rows are judged each; an empty table gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quotelake.llm.common import attach, beta_prior, posterior_low, ship_package, stage_table

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5
HOST_Z = 1.645

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def repeated_words(tokens: list[bytes], size: int = 3) -> int:
    """Words that lie in a window of three words found at least twice in the text."""
    if len(tokens) <= size:
        return 0
    codes = np.fromiter(map(hash, tokens), dtype=np.int64, count=len(tokens)).view(np.uint64)
    windows = len(tokens) - size + 1
    keys = np.zeros(windows, dtype=np.uint64)
    for i in range(size):
        keys = (keys ^ codes[i:i + windows]) * _MIX[i]
        keys ^= keys >> np.uint64(29)
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    found = np.isin(keys, twice)
    covered = np.zeros(len(tokens), dtype=bool)
    for i in range(size):
        covered[i:i + windows] |= found
    return int(covered.sum())


def measure_text(text: str | None) -> tuple[int, int, int, int, int]:
    """The five measures of a text, in the order of ``MEASURES``."""
    text = text or ""
    tokens = text.encode().split()  # bytes split at ASCII white space
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (len(tokens), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(tokens))


def _measure(column: pa.Array) -> list[pa.Array]:
    rows = [measure_text(x.as_py()) for x in column]
    return [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(MEASURES))]


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """The columns ``keep`` and the measures of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), *_measure(batch.column(len(keep)))],
                names=[*keep, *MEASURES])

    ship_package(docs.sparkSession)
    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"{m} long" for m in MEASURES])
    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def base_failed() -> Column:
    """The document's own rules on its measures."""
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_verdicts(judged: DataFrame, host: str = "source") -> DataFrame:
    """One row per host: documents, failures, shrunk rate's lower bound, host_failed."""
    hosts = stage_table(judged.groupBy(host).agg(
        F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("bad")), "hosts")
    mean, strength = beta_prior(hosts)
    low = posterior_low(F.col("bad"), F.col("n"), F.lit(mean), strength, HOST_Z)
    return hosts.withColumns({"prior_rate": F.lit(mean), "prior_strength": F.lit(strength), "host_low": low,
                              "host_failed": low > MAX_HOST_RATE})


def judge(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """doc_id, host, the measures and base_failed of every document; documents and failures of
    its host, the prior, the lower bound of the host's rate, host_failed; kept."""
    judged = stage_table(measure(docs, text, ("doc_id", host)).withColumn("base_failed", base_failed()),
                         "measures")
    verdicts = host_verdicts(judged, host).select(
        host, F.col("n").alias("host_n"), F.col("bad").alias("host_bad"), "prior_rate", "prior_strength", "host_low", "host_failed")
    return attach(judged, verdicts, [host]).withColumn(
        "kept", ~(F.col("base_failed") | F.col("host_failed")))


def keep_documents(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""
    judged = measure(docs, text, (host,)).withColumn("base_failed", base_failed())
    verdicts = stage_table(host_verdicts(judged, host).select(host, "host_failed"), "verdicts")
    names = docs.columns
    at = names.index(text)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, *_, repeats = (x.to_numpy() for x in _measure(batch.column(at)))
            failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
            yield batch.filter(pa.array(~failed))

    rows = docs.mapInArrow(passing, docs.schema)
    return attach(rows, verdicts, [host]).filter(~F.col("host_failed")).select(*names)
