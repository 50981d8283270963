"""Labels and codes used by the marts and the serving queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label texts that stored marts carry and serving queries match on.
UP, DOWN = "상행", "하행"
UNKNOWN_DIRECTION = "미상"
BANDS = ("새벽", "출근", "점심", "퇴근", "밤")
RUSH_BANDS = ("출근", "퇴근")
WEEKDAY = "평일"
SATURDAY = "토요일"
HOLIDAY = "휴일"
ALL = "(전체)"

# Direction codes of the position feed; timetable tags.
DIRECTION_CODES = ("0", "1")
WEEK_TAGS = ("1", "2", "3")
INOUT_TAGS = ("1", "2")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def direction_col(updn_line: Column | str = "updn_line") -> Column:
    code = _col(updn_line)
    return F.when(code == "0", UP).when(code == "1", DOWN).otherwise(UNKNOWN_DIRECTION)


def time_band_col(ts: Column | str) -> Column:
    """Fixed hours of the bands; the last one runs over midnight."""
    hour = F.hour(_col(ts))
    return (
        F.when(hour.between(5, 6), "새벽")
        .when(hour.between(7, 9), "출근")
        .when(hour.between(10, 16), "점심")
        .when(hour.between(17, 19), "퇴근")
        .otherwise("밤")
    )


def day_type_col(ts: Column | str) -> Column:
    """Weekends only; public holidays count as the weekday they fall on."""
    day = F.dayofweek(_col(ts))
    return F.when(day == 1, HOLIDAY).when(day == 7, SATURDAY).otherwise(WEEKDAY)


def week_tag_col(ts: Column | str) -> Column:
    """Timetable tag of a date: 1 weekday, 2 Saturday, 3 Sunday."""
    day = F.dayofweek(_col(ts))
    return F.when(day == 1, "3").when(day == 7, "2").when(day.isNotNull(), "1")


def inout_tag_col(updn_line: Column | str = "updn_line") -> Column:
    """Timetable direction tag of a position-feed direction code."""
    code = _col(updn_line)
    return F.when(code == "0", "1").when(code == "1", "2")


def label_col(
    station: Column | str = "statn_nm",
    direction: Column | str = "direction",
    band: Column | str = "time_band",
) -> Column:
    """``station(direction·band)`` for charts."""
    return F.concat(
        _col(station), F.lit("("), _col(direction), F.lit("·"), _col(band), F.lit(")")
    )
