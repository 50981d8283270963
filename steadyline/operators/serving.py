"""Ranked, filtered and pivoted queries over the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steadyline.functions.labels import ALL, BANDS, RUSH_BANDS

# Grain columns close every ordering, so that ties at a cut are settled the same way each time.
_TIE_BREAKS = ("line", "statn_id", "statn_nm", "direction", "time_band", "day_type")


def bi_filter(
    mart: DataFrame, line: str | None = None, band: str | None = None, min_n: int = 10
) -> DataFrame:
    """Groups with enough samples, optionally of one line and one time band."""
    kept = mart.filter(F.col("headway_samples") >= min_n)
    if line not in (None, ALL):
        kept = kept.filter(F.col("line") == line)
    if band not in (None, ALL):
        kept = kept.filter(F.col("time_band") == band)
    return kept


def _worst_first(df: DataFrame, n: int) -> DataFrame:
    ties = [c for c in _TIE_BREAKS if c in df.columns]
    return df.orderBy(F.col("cv").desc_nulls_last(), *ties).limit(n)


_TOP_COLUMNS = ("line", "statn_nm", "direction", "time_band")


def top_unstable(
    mart: DataFrame, bands: Sequence[str] | None = RUSH_BANDS, min_n: int = 5, n: int = 15
) -> DataFrame:
    """The ``n`` groups with the highest CV; ``bands=None`` looks at all of them."""
    kept = mart.filter(F.col("headway_samples") >= min_n)
    if bands is not None:
        kept = kept.filter(F.col("time_band").isin(*bands))
    return _worst_first(kept, n).select(
        *_TOP_COLUMNS,
        F.col("headway_samples").alias("n"),
        "p50_sec",
        "p90_sec",
        "cv",
        "over_1p5x_ratio",
    )


def top_unstable_explore(
    explore: DataFrame, bands: Sequence[str] = RUSH_BANDS, n: int = 20
) -> DataFrame:
    """The same ranking over the exploratory groups."""
    kept = explore.filter(F.col("time_band").isin(*bands))
    return _worst_first(kept, n).select(*_TOP_COLUMNS, "n", "p50_sec", "p90_sec", "cv")


def _mean_of_rounded(name: str) -> Column:
    """Mean of a three-decimal column, to three decimals.

    Summed in whole thousandths: neither row order nor binary fractions can shift a rounding.
    """
    thousandths = F.sum(F.round(F.col(name) * 1000).cast("long"))
    return F.round(thousandths / F.count(name)) / 1000


def mean_cv(mart: DataFrame, min_n: int = 10) -> DataFrame:
    """Mean CV, mean P50 and group count per line and time band."""
    return (
        mart.filter(F.col("headway_samples") >= min_n)
        .groupBy("line", "time_band")
        .agg(
            _mean_of_rounded("cv").alias("avg_cv"),
            F.round(F.avg("p50_sec"), 0).alias("avg_headway_sec"),
            F.count(F.lit(1)).alias("n_groups"),
        )
    )


def mean_cv_explore(explore: DataFrame) -> DataFrame:
    return explore.groupBy("line", "time_band").agg(
        F.count(F.lit(1)).alias("groups"),
        _mean_of_rounded("cv").alias("avg_cv"),
        F.round(F.avg("p50_sec"), 0).alias("avg_p50_sec"),
    )


def cv_matrix(mart: DataFrame, min_n: int = 10, bands: Sequence[str] = BANDS) -> DataFrame:
    """Line × band matrix of mean CV; cells without a value hold 0."""
    matrix = mean_cv(mart, min_n).groupBy("line").pivot("time_band", list(bands)).agg(F.first("avg_cv"))
    return matrix.fillna(0.0, subset=list(bands))


def latest_positions(current: DataFrame, n: int = 10) -> DataFrame:
    """Rows of the current table with the latest receive time."""
    return (
        current.orderBy(F.col("recptn_dt").desc_nulls_last(), "event_id")
        .limit(n)
        .select("train_no", "statn_nm", "statn_tnm", "updn_line", "train_sttus", "recptn_dt")
    )


def train_sequence(
    arrivals: DataFrame, train_no: str, n: int = 40, tie: Sequence[str] = ("seq",)
) -> DataFrame:
    """First arrivals of one train, in order."""
    return (
        arrivals.filter(F.col("train_no") == train_no)
        .orderBy("arrival_ts", *tie)
        .limit(n)
        .select("statn_nm", "statn_tnm", "updn_line", "arrival_ts")
    )


def top_delayed(by_station: DataFrame, n: int = 5) -> DataFrame:
    """Stations with the most delayed arrivals, then the highest rate."""
    return by_station.orderBy(F.desc("delayed"), F.desc("delay_rate"), "station_nm").limit(n)
