"""Group statistics of whole-second durations, computed from value counts.

Durations are whole seconds below a bound, so a group has at most that many distinct values
however many rows it has. Counting (group, value) first combines on the map side; every
statistic then comes exactly from the counts, after one shuffle of the counts alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, keys: Sequence[str], value: str, *labels: str) -> DataFrame:
    """Rows per (keys, value); ``labels`` are kept apart for a later ``max``."""
    return df.groupBy(*keys, *labels, value).agg(F.count(F.lit(1)).alias("_n"))


def _ranked(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    group = Window.partitionBy(*keys)
    upto = group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return counts.select(
        "*",
        F.sum("_n").over(upto).alias("_upto"),
        F.sum("_n").over(group).alias("_total"),
    )


def _at_rank(value: str, share: float) -> Column:
    """Smallest value whose cumulative count reaches ``share`` of the group."""
    return F.min(F.when(F.col("_upto") >= F.lit(share) * F.col("_total"), F.col(value)))


def discrete_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float], count: str = "n"
) -> DataFrame:
    """Row count and quantiles (elements of the data, no interpolation) per group."""
    ranked = _ranked(value_counts(df, keys, value), keys, value)
    return ranked.groupBy(*keys).agg(
        F.sum("_n").alias(count),
        *[_at_rank(value, share).alias(name) for name, share in quantiles.items()],
    )


def spread(
    df: DataFrame, keys: Sequence[str], value: str, label: str | None = None, ratio: float = 1.5
) -> DataFrame:
    """Count, P50, P90, mean, sample deviation and share above ``ratio`` × P50 per group.

    ``n, p50, p90, mean, std, over`` (unrounded), with ``max(label)`` if given. The deviation is
    null for a single row.
    """
    labels = (label,) if label is not None else ()
    return spread_of_counts(value_counts(df, keys, value, *labels), keys, value, label, ratio)


def added_counts(counts: DataFrame, keys: Sequence[str], value: str, *labels: str) -> DataFrame:
    """One row per (keys, labels, value) from counts of several parts."""
    return counts.groupBy(*keys, *labels, value).agg(F.sum("_n").alias("_n"))


def spread_of_counts(
    counts: DataFrame, keys: Sequence[str], value: str, label: str | None = None, ratio: float = 1.5
) -> DataFrame:
    """:func:`spread` from :func:`value_counts`."""
    labels = (label,) if label is not None else ()
    group = Window.partitionBy(*keys)
    rows = _ranked(counts, keys, value).select(
        "*",
        (F.sum(F.col("_n") * F.col(value)).over(group) / F.col("_total")).alias("_mean"),
        _at_rank(value, 0.5).over(group).alias("_p50"),
    )
    deviation = F.col(value) - F.col("_mean")
    above = F.col(value) > F.lit(ratio) * F.col("_p50")
    return (
        rows.groupBy(*keys)
        .agg(
            *[F.max(name).alias(name) for name in labels],
            F.sum("_n").alias("n"),
            F.max("_p50").alias("p50"),
            _at_rank(value, 0.9).alias("p90"),
            F.max("_mean").alias("mean"),
            F.sum(F.col("_n") * deviation * deviation).alias("_squares"),
            F.sum(F.when(above, F.col("_n")).otherwise(0)).alias("_above"),
        )
        .withColumn("std", F.when(F.col("n") > 1, F.sqrt(F.col("_squares") / (F.col("n") - 1))))
        .withColumn("over", F.col("_above") / F.col("n"))
        .drop("_squares", "_above")
    )
