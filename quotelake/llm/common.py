"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Sequence
from functools import reduce
from operator import and_
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quotelake.sources.workdir import new_workdir

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

BROADCAST_BYTES = 16 * 1024 * 1024

# Rows per Arrow batch: the usual ten thousand are meant for numbers, not for documents.
BATCH_DOCUMENTS = 1000
BATCH_BYTES = 8 * 1024 * 1024


ROOT = Path(__file__).resolve().parents[2]


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, unless the driver was started with it on
    ``PYTHONPATH``, which workers inherit, or it was shipped before. Batches sent to them
    hold ``BATCH_DOCUMENTS`` rows and ``BATCH_BYTES``, or a longer row, from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_DOCUMENTS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or "quotelake.zip" in context._python_includes:
        return
    # In the driver's folder of served files, which ends with the session.
    folder = tempfile.mkdtemp(dir=SparkFiles.getRootDirectory())
    context.addPyFile(shutil.make_archive(f"{folder}/quotelake", "zip", ROOT, "quotelake"))


def stage_table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a frame to the folder all nodes share and read it back: what follows neither
    repeats the work above nor depends on the executors that did it."""
    spark = df.sparkSession
    path = new_workdir(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def equal_keys(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Equality of all keys, null equal to null."""
    return reduce(and_, (a.eqNullSafe(b) for a, b in zip(left, right, strict=True)))


def null_marked(*columns: str) -> list[Column]:
    """The columns and whether each is null, for hashes: these pass over nulls, so that a value
    in one column and the same in the next would be equal."""
    return [x for c in columns for x in (F.col(c), F.col(c).isNull())]


def table_bytes(df: DataFrame) -> int:
    """Upper estimate of the memory of a staged frame, by its rows and the length of its strings."""
    texts = [F.coalesce(F.sum(F.octet_length(name)), F.lit(0))
             for name, kind in df.dtypes if kind in ("string", "binary")]
    rows, *lengths = df.agg(F.count("*"), *texts).first()
    return rows * 16 * (len(df.columns) + 1) + sum(lengths)


def attach(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join columns of ``small``, a staged table of one row per key, to ``big``.

    Null keys meet. ``small`` is broadcast when its measured size is under
    ``BROADCAST_BYTES``; beyond, both are shuffled by key and Spark splits the partitions
    of hot keys. Columns of ``big`` win a clash of names.
    """
    renamed = small.select(*(F.col(k).alias(f"__{k}") for k in keys),
                           *(c for c in small.columns if c not in keys and c not in big.columns))
    if table_bytes(small) <= BROADCAST_BYTES:
        renamed = F.broadcast(renamed)
    on = equal_keys([big[k] for k in keys], [renamed[f"__{k}"] for k in keys])
    return big.join(renamed, on, how).drop(*(f"__{k}" for k in keys))


def prefix_sums(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str], value: str,
                out: str) -> DataFrame:
    """Sum of ``value`` over the rows before each row of its group.

    Rows are ordered by ``bucket``, then ``order``. Sums run within (group, bucket) and the
    buckets' totals are summed apart, so a hot group is spread over its buckets. ``df`` is
    read twice: pass a staged table.
    """
    before = (Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    inner = df.withColumn(out, F.coalesce(F.sum(value).over(
        Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(*before)), zero))
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("__total"))
    offsets = totals.withColumn("__offset", F.coalesce(F.sum("__total").over(
        Window.partitionBy(*group).orderBy(bucket).rowsBetween(*before)), zero)).drop("__total")
    joined = attach(inner, stage_table(offsets, "offsets"), [*group, bucket])
    return joined.withColumn(out, F.col(out) + F.col("__offset")).drop("__offset")


def shuffle_key(*columns: Column) -> Column:
    """60-bit number from the columns, uniform, equal in any engine that has MD5."""
    text = F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("-")) for c in columns))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def beta_prior(rates: DataFrame, bad: str = "bad", n: str = "n") -> tuple[float, float]:
    """Mean and strength of a beta prior fitted by moments to groups of (bad, n).

    The prior's variance is that of the groups' rates less the binomial noise in them.
    Without spread left, or with one group, the strength is the number of observations;
    without observations the prior is even with strength 2.
    """
    seen = rates.filter(F.col(n) > 0)
    rate = F.col(bad) / F.col(n)
    row = seen.agg(F.count("*").alias("groups"), F.sum(n).alias("n"), F.sum(bad).alias("bad"),
                   F.avg(rate).alias("mean"), F.var_pop(rate).alias("var"),
                   F.avg(1 / F.col(n)).alias("inverse")).first()
    if not row["groups"]:
        return 0.5, 2.0
    mean = row["bad"] / row["n"]
    noise = mean * (1 - mean) * row["inverse"]
    spread = row["var"] - noise
    if spread <= 0 or mean in (0.0, 1.0):
        return mean, float(row["n"])
    return mean, max(1.0, mean * (1 - mean) / spread - 1)


def posterior_low(bad: Column, n: Column, mean: Column, strength: float, z: float) -> Column:
    """Lower bound of a rate: posterior mean less z posterior deviations."""
    total = n + F.lit(strength)
    post = (bad + mean * F.lit(strength)) / total
    return post - F.lit(z) * F.sqrt(post * (1 - post) / (total + 1))
