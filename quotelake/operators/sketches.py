"""Mergeable partial figures: quantiles by KLL sketches, distinct counts by HyperLogLog.

A sketch of a batch is a few kilobytes whatever the batch holds, is made before the shuffle and
can be stored; sketches of any batches, dates or groups are merged when read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KLL_K = 800
HLL_LOG_K = 12


def rank_error(k: int = KLL_K) -> float:
    """Stated error of a KLL quantile: share of rows by which its rank may be off."""
    return 2.296 / k ** 0.9723


def quantile_partials(df: DataFrame, column: str, by: tuple[str, ...], k: int = KLL_K) -> DataFrame:
    """One KLL sketch of a whole-number column per group; nulls do not count."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_bigint(F.col(column).cast("bigint"), F.lit(k)).alias("sketch"))


def merged_quantiles(partials: DataFrame, by: tuple[str, ...], fractions: dict[str, float]) -> DataFrame:
    """Merged sketches of each group: n and a quantile per name and fraction."""
    merged = partials.filter(F.col("sketch").isNotNull()).groupBy(*by).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))
    return merged.select(*by, F.kll_sketch_get_n_bigint("sketch").alias("n"), *(
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(fraction)).alias(name) for name, fraction in fractions.items()))


def quantiles_hold(df: DataFrame, column: str, by: tuple[str, ...], estimates: DataFrame,
                   fractions: dict[str, float], k: int = KLL_K) -> DataFrame:
    """Whether each estimate's rank among the rows is within the stated error, as ``<name>_holds``.

    ``estimates`` has a row per group, so that few values are joined to the rows.
    """
    aggregates = [F.count(column).alias("rows")]
    for name in fractions:
        aggregates += [F.count(F.when(F.col(column) < F.col(name), 1)).alias(f"{name}_below"),
                       F.count(F.when(F.col(column) <= F.col(name), 1)).alias(f"{name}_upto")]
    counted = df.select(*by, column).join(estimates.select(*by, *fractions), list(by)).groupBy(*by).agg(*aggregates)
    error = rank_error(k)
    return counted.select(*by, *(
        ((F.col(f"{name}_below") <= (fraction + error) * F.col("rows"))
         & (F.col(f"{name}_upto") >= (fraction - error) * F.col("rows"))).alias(f"{name}_holds")
        for name, fraction in fractions.items()))


def distinct_partials(df: DataFrame, column: str, by: tuple[str, ...], log_k: int = HLL_LOG_K) -> DataFrame:
    """One HyperLogLog sketch of a column per group."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, F.lit(log_k)).alias("sketch"))


def merged_distinct(partials: DataFrame, by: tuple[str, ...], name: str = "n_distinct") -> DataFrame:
    """About how many distinct values the merged sketches of each group saw."""
    return partials.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
