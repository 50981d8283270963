"""The batch jobs between the layers: log → arrivals → marts → previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from steadyline.operators.delay import (
    arrival_delay,
    delay_by_station,
    delay_by_timeband,
    nearest_schedule,
)
from steadyline.operators.events import normalize_events
from steadyline.operators.freshness import coverage, freshness_mart, gap_summary
from steadyline.operators.headways import MAX_HEADWAY_SEC, headway_mart
from steadyline.operators.serving import top_unstable
from steadyline.plans.incremental import STORED_ARRIVALS, between_dates, build_arrivals
from steadyline.sources.payloads import parse_position_payloads, to_keyed_json
from steadyline.sources.tables import read_arrivals, save_mart

__all__ = [
    "STORED_ARRIVALS",
    "between_dates",
    "build_arrivals",
    "build_delay_tables",
    "build_freshness_mart",
    "build_headway_mart",
    "events_from_payloads",
    "stored_arrivals",
]


def stored_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """Arrivals as :func:`build_arrivals` stores them with ``extra=("direct_at",)``."""
    return read_arrivals(spark, path, STORED_ARRIVALS)


def build_delay_tables(
    arrivals: DataFrame, timetable: DataFrame, names: dict[str, str], late_sec: int
) -> dict[str, DataFrame]:
    """Replace ``arrival_delay``, ``delay_by_station`` and ``delay_by_timeband``; return them as stored.

    ``names`` gives the table of each. The summaries read the stored delays, so matching runs once.
    """
    columns = ["line", "train_no", "station_nm", "direction", "time_band", "day_type", "arrival_ts",
               "actual_sec", "scheduled_sec", "delay_sec", "is_delayed", "dt"]
    matched = arrival_delay(nearest_schedule(arrivals, timetable), late_sec).select(*columns)
    delays = save_mart(matched, names["arrival_delay"])
    return {
        "arrival_delay": delays,
        "delay_by_station": save_mart(delay_by_station(delays), names["delay_by_station"]),
        "delay_by_timeband": save_mart(delay_by_timeband(delays), names["delay_by_timeband"]),
    }


def events_from_payloads(payloads: DataFrame) -> DataFrame:
    """Landed API responses (line, payload) → keyed JSON records (key, value), as the producer sends them."""
    rows, _errors = parse_position_payloads(payloads)
    events = normalize_events(rows, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
    return to_keyed_json(events)


def build_headway_mart(
    arrivals: DataFrame, name: str, max_headway_sec: int = MAX_HEADWAY_SEC
) -> tuple[DataFrame, DataFrame]:
    """Replace the regularity mart; return it and its rush-hour ranking, both read from the table."""
    mart = save_mart(headway_mart(arrivals, max_headway_sec), name)
    return mart, top_unstable(mart)


def build_freshness_mart(
    log: DataFrame, name: str, source_tz: str = "UTC"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Replace the freshness mart; return it with its coverage and gap summaries."""
    mart = save_mart(freshness_mart(log, source_tz), name)
    return mart, coverage(mart), gap_summary(mart)
