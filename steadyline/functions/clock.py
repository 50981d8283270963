"""Wall-clock arithmetic on TIMESTAMP_NTZ columns, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(text: str) -> Column:
    """Parse a receive-time text; unparseable text gives null instead of failing the job."""
    return F.col(text).try_cast("timestamp_ntz")


def day_seconds(ts: str) -> Column:
    """Whole seconds since midnight."""
    return F.expr(f"hour({ts}) * 3600 + minute({ts}) * 60 + second({ts})")


def wall_seconds(ts: str) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 on the same clock."""
    return F.expr(
        f"datediff(CAST({ts} AS DATE), DATE'1970-01-01') * 86400L"
        f" + hour({ts}) * 3600 + minute({ts}) * 60 + second({ts})"
    )


def minute_of(ts: str) -> Column:
    """The timestamp with its seconds removed."""
    return F.expr(f"{ts} - make_dt_interval(0, 0, 0, extract(SECOND FROM {ts}))")


def date_text(ts: str) -> Column:
    """``yyyy-MM-dd`` of a timestamp."""
    return F.expr(f"CAST(CAST({ts} AS DATE) AS STRING)")


def clock_text_seconds(text: str) -> Column:
    """Seconds since midnight of ``HH:MM:SS`` text; anything else gives null."""
    t = F.trim(text)
    part = F.split(t, ":")
    seconds = (
        part.getItem(0).cast("int") * 3600
        + part.getItem(1).cast("int") * 60
        + part.getItem(2).cast("int")
    )
    return F.when(t.rlike(r"^\d{1,2}:\d{2}:\d{2}$"), seconds)
