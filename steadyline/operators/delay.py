"""Delay against the timetable: nearest scheduled arrival and its summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from steadyline.functions.clock import clock_text_seconds, day_seconds
from steadyline.functions.labels import (
    INOUT_TAGS,
    WEEK_TAGS,
    day_type_col,
    direction_col,
    inout_tag_col,
    time_band_col,
    week_tag_col,
)

SERVICE = ("station_nm", "week_tag", "inout_tag")
# A service day runs from this second of the calendar day to the same of the next.
SERVICE_START_SEC = 3 * 3600
_DAY_SEC = 86_400


def _service_seconds(seconds: Column, start: int) -> Column:
    """Seconds since the midnight before the service day; after midnight they go on beyond 24 hours."""
    return F.when(seconds < start, seconds + _DAY_SEC).otherwise(seconds)


def nearest_schedule(
    arrivals: DataFrame, timetable: DataFrame, service_start_sec: int = SERVICE_START_SEC
) -> DataFrame:
    """Arrivals with the scheduled arrival closest in time and ``delay_sec = actual − scheduled``.

    Station name, direction and week tag must agree; the match stays within the service day, which
    starts at ``service_start_sec``: 00:10 belongs to the day before and meets 24:09 or 00:09. Of two equally close schedules the earlier one wins. Arrivals without any schedule drop.

    The answer depends on the second of the day alone, so it is worked out once per (service,
    second): both inputs shrink to distinct seconds, about one day's worth per service, before
    they are ordered. Arrivals then join it on service and second, which spreads a busy station.
    """
    actual = arrivals.withColumns(
        {
            "station_nm": F.col("statn_nm"),
            "week_tag": week_tag_col(F.expr(f"arrival_ts - make_dt_interval(0, 0, 0, {service_start_sec})")),
            "inout_tag": inout_tag_col("updn_line"),
            "actual_sec": _service_seconds(day_seconds("arrival_ts"), service_start_sec),
        }
    )
    planned = _service_seconds(clock_text_seconds("arrive_time"), service_start_sec)
    scheduled = (
        timetable.select(*SERVICE, planned.alias("_sec"))
        .filter(F.col("_sec").isNotNull())
        .distinct()
        .withColumn("_scheduled", F.col("_sec"))
    )
    asked = (
        actual.select(*SERVICE, F.col("actual_sec").alias("_sec"))
        .distinct()
        .withColumn("_scheduled", F.lit(None).cast("int"))
    )
    service = Window.partitionBy(*SERVICE)
    is_asked = F.col("_scheduled").isNull()
    forward = service.orderBy("_sec", is_asked)
    backward = service.orderBy(F.desc("_sec"), is_asked)
    before = F.last("_scheduled", ignorenulls=True).over(forward)
    after = F.last("_scheduled", ignorenulls=True).over(backward)
    nearest = (
        scheduled.unionByName(asked)
        .select("*", before.alias("_before"), after.alias("_after"))
        .filter(is_asked)
        .withColumn(
            "scheduled_sec",
            F.when(
                F.col("_after").isNull()
                | (F.col("_sec") - F.col("_before") <= F.col("_after") - F.col("_sec")),
                F.col("_before"),
            ).otherwise(F.col("_after")),
        )
        .filter(F.col("scheduled_sec").isNotNull())
        .select(*SERVICE, F.col("_sec").alias("actual_sec"), "scheduled_sec")
    )
    return actual.join(nearest, [*SERVICE, "actual_sec"]).withColumn(
        "delay_sec", (F.col("actual_sec") - F.col("scheduled_sec")).cast("long")
    )


def arrival_delay(matched: DataFrame, late_sec: int) -> DataFrame:
    """Matched arrivals with labels and ``is_delayed`` (1 where the delay exceeds ``late_sec``)."""
    return matched.withColumns(
        {
            "direction": direction_col("updn_line"),
            "time_band": time_band_col("arrival_ts"),
            "day_type": day_type_col("arrival_ts"),
            "is_delayed": (F.col("delay_sec") > late_sec).cast("int"),
        }
    )


def delay_by(delays: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Arrivals, delayed arrivals, delay rate and mean delay per group."""
    return delays.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("arrivals"),
        F.sum("is_delayed").alias("delayed"),
        F.round(F.avg("is_delayed"), 3).alias("delay_rate"),
        F.round(F.avg("delay_sec"), 1).alias("avg_delay_sec"),
    )


def delay_by_station(delays: DataFrame) -> DataFrame:
    return delay_by(delays, ["station_nm"])


def delay_by_timeband(delays: DataFrame) -> DataFrame:
    return delay_by(delays, ["day_type", "time_band"])


def delay_by_direction(delays: DataFrame) -> DataFrame:
    return delay_by(delays, ["direction"]).drop("delay_rate")


def timetable_grid(stations: DataFrame) -> DataFrame:
    """Every station × week tag × direction: six rows per station."""
    week_tags = F.array(*[F.lit(tag) for tag in WEEK_TAGS])
    inout_tags = F.array(*[F.lit(tag) for tag in INOUT_TAGS])
    return stations.withColumn("week_tag", F.explode(week_tags)).withColumn(
        "inout_tag", F.explode(inout_tags)
    )


def missing_timetable(stations: DataFrame, timetable: DataFrame) -> DataFrame:
    """Grid cells no timetable row covers."""
    cell = ["station_cd", "week_tag", "inout_tag"]
    return timetable_grid(stations).join(timetable.select(*cell).distinct(), cell, "left_anti")
