"""Marts kept by date: what each date contributes is stored, so new or late dates cost their own rows.

The stored parts add up to the same marts as a run over everything (``operators.headways.mart_of_counts``,
``operators.freshness.mart_of_parts``, ``gaps_of_days``, ``coverage_of_days``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from steadyline.operators.freshness import EDGE_MIN, HICCUP_MIN, day_gaps, freshness_parts
from steadyline.operators.headways import GRAIN, MAX_HEADWAY_SEC, headway_counts
from steadyline.sources.tables import folders, replace_dates

COUNTS_SCHEMA = (
    "line STRING, statn_id STRING, direction STRING, time_band STRING, day_type STRING, "
    "statn_nm STRING, headway_sec BIGINT, _n BIGINT, dt STRING"
)
PARTS_SCHEMA = (
    "line STRING, minute_ts TIMESTAMP_NTZ, train_no STRING, records BIGINT, "
    "distinct_trains BIGINT, ingest_lag_avg_sec DOUBLE, dt STRING"
)
_IS_DATE = r"^\d{4}-\d{2}-\d{2}$"


def _shifted(day: str, days: int) -> str:
    return (date.fromisoformat(day) + timedelta(days=days)).isoformat()


def _near(dates: Iterable[str], before: int, after: int) -> list[str]:
    return sorted({_shifted(day, k) for day in dates for k in range(-before, after + 1)})


def _emptied(spark: SparkSession, path: str, replaced: Iterable[str], rows: DataFrame) -> list[str]:
    """Stored dates among ``replaced`` that ``rows`` has none of."""
    present = folders(spark, path, "dt=") & set(replaced)
    return sorted(present - {r.dt for r in rows.select("dt").distinct().collect()}) if present else []


# ---- headway counts ----------------------------------------------------------------------------


def build_headway_counts(
    arrivals: DataFrame,
    path: str,
    max_headway_sec: int = MAX_HEADWAY_SEC,
    extra_keys: Sequence[str] = (),
    dates: Iterable[str] | None = None,
) -> None:
    """Store the headway counts of all dates, or of ``dates`` whose arrivals are new or have changed.

    The first headways of a date look back across midnight, so the dates that follow within the cutoff are counted
    again too. Only arrivals of the dates concerned and of the cutoff before them are read.
    """
    if dates is None:
        counts = headway_counts(arrivals, max_headway_sec, extra_keys)
        counts.hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt").parquet(path)
        return
    days = -(-max_headway_sec // 86_400)
    concerned = _near(dates, 0, days)
    near = arrivals.filter(F.col("dt").isin(_near(concerned, days, 0)))
    counts = headway_counts(near, max_headway_sec, extra_keys).filter(F.col("dt").isin(concerned))
    replace_dates(counts, path, _emptied(arrivals.sparkSession, path, concerned, counts))


def stored_headway_counts(spark: SparkSession, path: str, extra_keys: Sequence[str] = ()) -> DataFrame:
    extra = "".join(f"{name} STRING, " for name in extra_keys)
    return spark.read.schema(extra + COUNTS_SCHEMA).parquet(path).select(
        *GRAIN, *extra_keys, "statn_nm", "headway_sec", "_n", "dt"
    )


# ---- freshness parts ---------------------------------------------------------------------------


def build_freshness_parts(
    log: DataFrame, path: str, source_tz: str = "UTC", dates: Iterable[str] | None = None
) -> None:
    """Store what each log date contributes to the freshness mart: of all dates, or of ``dates`` and of texts that are none."""
    if dates is None:
        parts = freshness_parts(log, source_tz)
        parts.hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt").parquet(path)
        return
    dates = sorted(dates)
    unreadable = ~F.col("dt").rlike(_IS_DATE)
    parts = freshness_parts(log.filter(F.col("dt").isin(dates) | unreadable), source_tz)
    replace_dates(parts, path, _emptied(log.sparkSession, path, dates, parts))


def stored_freshness_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARTS_SCHEMA).parquet(path)


def freshness_days(parts: DataFrame, edge_min: float = EDGE_MIN, hiccup_min: float = HICCUP_MIN) -> DataFrame:
    """``day_gaps`` of stored parts; trains with unreadable times are one minute of their line, as in the mart."""
    minutes = parts.groupBy("line", "minute_ts").agg(F.sum("records").alias("records"))
    return day_gaps(minutes, edge_min, hiccup_min)
