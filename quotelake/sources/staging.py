"""Intermediate tables in the folder that all nodes share."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quotelake.sources.workdir import new_workdir

BROADCAST_BYTES = 16 * 1024 * 1024
ROW_BYTES = 16  # of a fixed-width value in a broadcast row


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write a frame and read it back: what follows does not repeat the work above."""
    path = new_workdir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(staged: DataFrame) -> DataFrame:
    """A staged frame, marked for broadcast if its measured size is under ``BROADCAST_BYTES``."""
    texts = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c, kind in staged.dtypes if kind in ("string", "binary")]
    rows, *lengths = staged.agg(F.count("*"), *texts).first()
    size = rows * ROW_BYTES * (len(staged.columns) + 1) + sum(lengths)
    return F.broadcast(staged) if size <= BROADCAST_BYTES else staged
