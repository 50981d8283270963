"""Headways between consecutive arrivals and the regularity marts built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from steadyline.functions.clock import date_text, wall_seconds
from steadyline.functions.labels import (
    DIRECTION_CODES,
    day_type_col,
    direction_col,
    time_band_col,
)
from steadyline.operators.statistics import (
    added_counts,
    discrete_quantiles,
    spread,
    spread_of_counts,
    value_counts,
)

# Grain of the regularity mart and the default cutoffs.
GRAIN = ("line", "statn_id", "direction", "time_band", "day_type")
MAX_HEADWAY_SEC = 900
EXPLORE_MAX_HEADWAY_SEC = 600
EXPLORE_MIN_SAMPLES = 15

# Cutoffs per bucket: a bucket repeats one cutoff's worth of its predecessor, here a quarter.
_CUTOFFS_PER_BUCKET = 4


def headways(
    arrivals: DataFrame,
    max_headway_sec: int = MAX_HEADWAY_SEC,
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """Whole seconds since the previous arrival at the same line, station and direction.

    Kept where ``0 < headway ≤ max_headway_sec``; labels belong to the later arrival. Arrivals
    in the same second differ by zero and drop out; the first of them has the headway. The
    predecessor that counts is never further away than the cutoff, hence groups are cut into time
    buckets, each preceded by a copy of the last cutoff's worth of rows of the bucket before.
    """
    keys = ["line", "statn_id", "updn_line", *extra_keys]
    width = max_headway_sec * _CUTOFFS_PER_BUCKET
    seconds = (
        arrivals.filter(F.col("updn_line").isin(*DIRECTION_CODES))
        .select(*keys, "statn_nm", "arrival_ts", wall_seconds("arrival_ts").alias("_sec"))
        .filter(F.col("_sec").isNotNull())
    )
    home = F.floor(F.col("_sec") / width)
    near_end = F.pmod(F.col("_sec"), F.lit(width)) >= width - max_headway_sec
    placed = seconds.withColumn("_home", home).withColumn(
        "_bucket",
        F.explode(
            F.when(near_end, F.array(F.col("_home"), F.col("_home") + 1)).otherwise(
                F.array(F.col("_home"))
            )
        ),
    )
    ordered = Window.partitionBy(*keys, "_bucket").orderBy("_sec", "arrival_ts", "statn_nm")
    gap = F.col("_sec") - F.lag("_sec").over(ordered)
    return (
        placed.withColumn("headway_sec", gap)
        .filter((F.col("_bucket") == F.col("_home")) & F.col("headway_sec").between(1, max_headway_sec))
        .select(
            "line",
            "statn_id",
            "statn_nm",
            direction_col("updn_line").alias("direction"),
            time_band_col("arrival_ts").alias("time_band"),
            day_type_col("arrival_ts").alias("day_type"),
            *extra_keys,
            "arrival_ts",
            "headway_sec",
        )
    )


def _complete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows an inner equi-join on ``keys`` would keep."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def group_median(headway_rows: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """P50 headway of each group."""
    return discrete_quantiles(headway_rows, keys, "headway_sec", {"grp_p50": 0.5}).drop("n")


def with_group_median(headway_rows: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """Headways joined with the P50 of their group; rows with a null key drop.

    The mart does not need this join (:func:`headway_mart` works on value counts); it serves
    row-level comparison against the group.
    """
    rows = _complete(headway_rows, keys)
    return rows.join(group_median(rows, keys), list(keys))


def headway_mart(
    arrivals: DataFrame,
    max_headway_sec: int = MAX_HEADWAY_SEC,
    ratio: float = 1.5,
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """Regularity per line, station, direction, time band and day type.

    ``cv`` is the sample deviation over the mean; ``over_1p5x_ratio`` the share of headways
    strictly above ``ratio`` × the observed P50. ``extra_keys`` (for instance ``direct_at``) refine
    both the headways and the grain.
    """
    grain = [*GRAIN, *extra_keys]
    rows = _complete(headways(arrivals, max_headway_sec, extra_keys), grain)
    return _mart(value_counts(rows, grain, "headway_sec", "statn_nm"), ratio, extra_keys)


def headway_counts(
    arrivals: DataFrame, max_headway_sec: int = MAX_HEADWAY_SEC, extra_keys: Sequence[str] = ()
) -> DataFrame:
    """How often each headway occurs per date of the later arrival and group: counts of dates add up to a mart."""
    grain = [*GRAIN, *extra_keys]
    rows = _complete(headways(arrivals, max_headway_sec, extra_keys), grain)
    return value_counts(rows.withColumn("dt", date_text("arrival_ts")), ["dt", *grain], "headway_sec", "statn_nm")


def mart_of_counts(counts: DataFrame, ratio: float = 1.5, extra_keys: Sequence[str] = ()) -> DataFrame:
    """The regularity mart of :func:`headway_mart` from the counts of its dates."""
    return _mart(added_counts(counts, [*GRAIN, *extra_keys], "headway_sec", "statn_nm"), ratio, extra_keys)


def _mart(counts: DataFrame, ratio: float, extra_keys: Sequence[str]) -> DataFrame:
    stats = spread_of_counts(counts, [*GRAIN, *extra_keys], "headway_sec", label="statn_nm", ratio=ratio)
    return stats.select(
        "line",
        "statn_id",
        "statn_nm",
        "direction",
        "time_band",
        "day_type",
        *extra_keys,
        F.col("n").alias("headway_samples"),
        F.col("p50").alias("p50_sec"),
        F.col("p90").alias("p90_sec"),
        F.round("mean", 0).alias("mean_sec"),
        F.round("std", 1).alias("std_sec"),
        F.round(F.col("std") / F.col("mean"), 3).alias("cv"),
        F.round("over", 3).alias("over_1p5x_ratio"),
    )


def headway_explore(
    arrivals: DataFrame,
    min_samples: int = EXPLORE_MIN_SAMPLES,
    max_headway_sec: int = EXPLORE_MAX_HEADWAY_SEC,
) -> DataFrame:
    """Exploratory form: no day type, one row per station name, small groups left out."""
    grain = ["line", "statn_id", "statn_nm", "direction", "time_band"]
    stats = spread(headways(arrivals, max_headway_sec), grain, "headway_sec")
    return stats.filter(F.col("n") >= min_samples).select(
        "line",
        "statn_id",
        "statn_nm",
        "direction",
        "time_band",
        "n",
        F.col("p50").alias("p50_sec"),
        F.col("p90").alias("p90_sec"),
        F.round(F.col("std") / F.col("mean"), 3).alias("cv"),
    )
