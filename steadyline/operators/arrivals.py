"""Arrival events recovered from station changes, and the travel times between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from steadyline.functions.clock import date_text, wall_seconds
from steadyline.operators.events import valid_positions
from steadyline.operators.sequence import match_runs, with_previous
from steadyline.operators.statistics import discrete_quantiles

# Columns of an arrival and its primary key.
ARRIVAL_FIELDS = ("line", "train_no", "statn_id", "statn_nm", "statn_tnm", "updn_line")
ARRIVAL_KEY = ("line", "train_no", "statn_id", "arrival_ts")


def timed_positions(log: DataFrame) -> DataFrame:
    """Positions that can be arrivals: with a station and a readable receive time, whose date is ``dt``."""
    rows = valid_positions(log).filter(F.col("recptn_ts").isNotNull())
    return rows.withColumn("dt", date_text("recptn_ts"))


def _bucket(ts: str, bucket_sec: int) -> Column:
    return F.floor(wall_seconds(ts) / bucket_sec)


def extract_arrivals(
    log: DataFrame,
    keys: Sequence[str] = ("train_no",),
    tie: Sequence[str] = ("seq",),
    extra: Sequence[str] = (),
    bucket_sec: int = 900,
    seed: DataFrame | None = None,
) -> DataFrame:
    """Rows of a train, in time order, whose station differs from the row before.

    ``keys`` says what a train is: the train number alone by default, so a number reused on another
    line or day continues the same sequence; pass ``("line", "train_no", "dt")`` to separate them.
    ``tie`` orders equal receive times. ``extra`` carries further log columns (``direct_at``).
    ``seed`` holds earlier arrivals that say where trains were before ``log`` begins; they are not returned.
    """
    rows = timed_positions(log).select(
        *dict.fromkeys([*ARRIVAL_FIELDS, *extra, *tie, "recptn_ts", "dt"])
    )
    if seed is not None:
        known = seed.withColumnRenamed("arrival_ts", "recptn_ts").select(*rows.columns)
        rows = rows.withColumn("_seed", F.lit(False)).unionByName(known.withColumn("_seed", F.lit(True)))

    def changed() -> Column:
        return F.col("_prev_statn").isNull() | (F.col("statn_id") != F.col("_prev_statn"))

    found = with_previous(
        rows,
        keys,
        ("recptn_ts", *tie),
        {"_prev_statn": "statn_id"},
        _bucket("recptn_ts", bucket_sec),
        keep=changed,
    )
    if seed is not None:
        found = found.filter(~F.col("_seed")).drop("_seed")
    return (
        found.drop("_prev_statn")
        .withColumnRenamed("recptn_ts", "arrival_ts")
    )


def arrival_runs(
    log: DataFrame,
    keys: Sequence[str] = ("train_no",),
    tie: Sequence[str] = ("seq",),
    bucket_sec: int = 900,
) -> DataFrame:
    """The pattern form of :func:`extract_arrivals`: one row per stay, with its last poll and length."""
    return match_runs(
        timed_positions(log),
        keys,
        ("recptn_ts", *tie),
        "statn_id",
        [*ARRIVAL_FIELDS, *tie, "recptn_ts", "dt"],
        _bucket("recptn_ts", bucket_sec),
    ).withColumnRenamed("recptn_ts", "arrival_ts")


def section_traversal(arrivals: DataFrame, tie: Sequence[str] = ("seq",)) -> DataFrame:
    """Travel time between a train's consecutive arrivals of one day.

    A window holds the arrivals of one train on one day, which their number per day bounds.
    """
    rows = arrivals.select(
        *dict.fromkeys(["line", "train_no", "dt", "statn_id", "statn_nm", "arrival_ts", *tie])
    )
    of_day = Window.partitionBy("train_no", "dt").orderBy("arrival_ts", *tie)
    linked = rows.withColumns(
        {
            "from_statn_id": F.lag("statn_id").over(of_day),
            "from_statn_nm": F.lag("statn_nm").over(of_day),
            "depart_ts": F.lag("arrival_ts").over(of_day),
        }
    )
    return linked.filter(F.col("depart_ts").isNotNull()).select(
        "line",
        "train_no",
        "dt",
        "from_statn_id",
        "from_statn_nm",
        F.col("statn_id").alias("to_statn_id"),
        F.col("statn_nm").alias("to_statn_nm"),
        "depart_ts",
        "arrival_ts",
        (wall_seconds("arrival_ts") - wall_seconds("depart_ts")).alias("traversal_sec"),
    )


def section_summary(traversal: DataFrame) -> DataFrame:
    """Trips, P50 and P90 travel time per section."""
    return discrete_quantiles(
        traversal,
        ("line", "from_statn_id", "to_statn_id"),
        "traversal_sec",
        {"p50_sec": 0.5, "p90_sec": 0.9},
        count="trips",
    )


def one_row_per_key(arrivals: DataFrame, tie: Sequence[str] = ("seq",)) -> DataFrame:
    """The last row of each arrival key, as a keyed table would hold it."""
    rest = [c for c in arrivals.columns if c not in ARRIVAL_KEY]
    return (
        arrivals.groupBy(*ARRIVAL_KEY)
        .agg(F.max_by(F.struct(*rest), F.struct(*tie)).alias("_row"))
        .select(*ARRIVAL_KEY, "_row.*")
        .select(*arrivals.columns)
    )
