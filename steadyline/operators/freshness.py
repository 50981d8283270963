"""Per-minute receipt of positions: heartbeat, coverage and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from steadyline.functions.clock import date_text, minute_of, wall_clock, wall_seconds
from steadyline.operators.sequence import with_previous

# Minutes above which a gap is a window edge, and above which it is a hiccup.
EDGE_MIN = 30
HICCUP_MIN = 1.5


def _epoch_seconds(df: DataFrame, name: str) -> Column:
    """Seconds since the epoch; a timestamp without zone is read as UTC."""
    if isinstance(df.schema[name].dataType, TimestampNTZType):
        return wall_seconds(name)
    return F.unix_timestamp(name)


def _received(log: DataFrame, source_tz: str, *more: str) -> DataFrame:
    """(line, train_no, more, minute_ts, _lag) of every record with a receive text."""
    rows = log.filter(F.col("recptn_dt").isNotNull() & (F.col("recptn_dt") != "")).select(
        "line", "train_no", *more, wall_clock("recptn_dt").alias("recptn_ts"), "ingested_at"
    )
    in_utc = F.convert_timezone(F.lit(source_tz), F.lit("UTC"), "recptn_ts")
    rows = rows.withColumn("received_utc", in_utc)
    return rows.select(
        "line",
        "train_no",
        *more,
        minute_of("recptn_ts").alias("minute_ts"),
        (_epoch_seconds(rows, "ingested_at") - wall_seconds("received_utc")).alias("_lag"),
    )


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("train_no").alias("distinct_trains"),
        F.round(F.avg("_lag"), 1).alias("ingest_lag_avg_sec"),
    ]


def freshness_mart(log: DataFrame, source_tz: str = "UTC") -> DataFrame:
    """Records, distinct trains and mean receive→ingest lag per line and minute.

    Receive times are local text of ``source_tz``. The lag compares them with processing time, so
    records of a drained backlog show how long they waited, not how slow ingestion was.
    """
    return _received(log, source_tz).groupBy("line", "minute_ts").agg(*_measures())


def freshness_parts(log: DataFrame, source_tz: str = "UTC") -> DataFrame:
    """What each log date contributes to the mart: (dt, line, minute_ts, train_no, records, distinct_trains, lag).

    A readable minute belongs to one date and is final there. Unreadable receive times of all dates make one
    row of the mart, whose trains must be told apart across dates: they stay one row for each train.
    """
    rows = _received(log, source_tz, "dt")
    timed = rows.filter(F.col("minute_ts").isNotNull()).groupBy("dt", "line", "minute_ts").agg(*_measures())
    untimed = rows.filter(F.col("minute_ts").isNull()).groupBy("dt", "line", "minute_ts", "train_no").agg(F.count(F.lit(1)).alias("records"))
    return timed.unionByName(untimed, allowMissingColumns=True).select(
        "line", "minute_ts", "train_no", "records", "distinct_trains", "ingest_lag_avg_sec", "dt"
    )


def mart_of_parts(parts: DataFrame) -> DataFrame:
    """The mart of :func:`freshness_mart` from the parts of its dates."""
    timed = parts.filter(F.col("minute_ts").isNotNull()).select(
        "line", "minute_ts", "records", "distinct_trains", "ingest_lag_avg_sec"
    )
    untimed = parts.filter(F.col("minute_ts").isNull()).groupBy("line", "minute_ts").agg(
        F.sum("records").alias("records"),
        F.count_distinct("train_no").alias("distinct_trains"),
        F.lit(None).cast("double").alias("ingest_lag_avg_sec"),
    )
    return timed.unionByName(untimed)


def coverage(freshness: DataFrame) -> DataFrame:
    return freshness.groupBy("line").agg(
        F.min("minute_ts").alias("first_min"),
        F.max("minute_ts").alias("last_min"),
        F.count(F.lit(1)).alias("minutes_with_data"),
        F.sum("records").alias("total_records"),
    )


def minute_gaps(freshness: DataFrame) -> DataFrame:
    """Minutes between consecutive minutes with data, per line.

    Days are looked at one by one, then their first and last minutes, so no task has all minutes of a line.
    """
    minutes = with_previous(
        freshness.select("line", "minute_ts"),
        ("line",),
        ("minute_ts",),
        {"_before": "minute_ts"},
        F.expr("datediff(CAST(minute_ts AS DATE), DATE'1970-01-01')"),
    )
    gap = (wall_seconds("minute_ts") - wall_seconds("_before")) / 60.0
    return minutes.select("line", "minute_ts", gap.alias("gap_min"))


def _summary(gap: Column, edge_min: float, hiccup_min: float) -> list[Column]:
    return [
        F.count_if(gap > edge_min).alias("window_boundaries"),
        F.count_if((gap > hiccup_min) & (gap <= edge_min)).alias("within_window_hiccups"),
        F.max(F.when(gap <= edge_min, gap)).alias("max_hiccup_min"),
    ]


def gap_summary(
    freshness: DataFrame, edge_min: float = EDGE_MIN, hiccup_min: float = HICCUP_MIN
) -> DataFrame:
    """Collection-window edges, hiccups inside a window and the longest hiccup, per line."""
    gaps = minute_gaps(freshness).filter(F.col("gap_min").isNotNull())
    found = gaps.groupBy("line").agg(*_summary(F.col("gap_min"), edge_min, hiccup_min))
    return found.withColumn("max_hiccup_min", F.round("max_hiccup_min", 1))


def day_gaps(freshness: DataFrame, edge_min: float = EDGE_MIN, hiccup_min: float = HICCUP_MIN) -> DataFrame:
    """One row per line and day: its first and last minute, minutes, records and the gaps inside the day.

    The minute of unreadable times has a row without day. :func:`gaps_of_days` and :func:`coverage_of_days` add days up.
    """
    seconds = wall_seconds("minute_ts")
    rows = freshness.withColumn("dt", date_text("minute_ts"))
    of_day = Window.partitionBy("line", "dt").orderBy("minute_ts")
    rows = rows.withColumn("_gap", (seconds - F.lag(seconds).over(of_day)) / 60.0)
    return rows.groupBy("line", "dt").agg(
        F.min("minute_ts").alias("first_min"),
        F.max("minute_ts").alias("last_min"),
        F.count(F.lit(1)).alias("minutes_with_data"),
        F.sum("records").alias("total_records"),
        F.count("_gap").alias("gaps"),
        *_summary(F.col("_gap"), edge_min, hiccup_min),
    )


def gaps_of_days(days: DataFrame, edge_min: float = EDGE_MIN, hiccup_min: float = HICCUP_MIN) -> DataFrame:
    """:func:`gap_summary` from :func:`day_gaps`: what lies inside the days, and the gaps from one day with data to the next."""
    timed = days.filter(F.col("dt").isNotNull())
    by_day = Window.partitionBy("line").orderBy("dt")  # one row a day
    border = ((wall_seconds("first_min") - F.lag(wall_seconds("last_min")).over(by_day)) / 60.0).alias("_gap")
    seen = timed.select("*", border)
    outer = [c.alias(f"_{n}") for n, c in enumerate(_summary(F.col("_gap"), edge_min, hiccup_min))]
    names = ("window_boundaries", "within_window_hiccups", "max_hiccup_min")
    added = seen.groupBy("line").agg(
        *[F.sum(name).alias(name) for name in names[:2]],
        F.max(names[2]).alias(names[2]),
        (F.sum("gaps") + F.count("_gap")).alias("gaps"),
        *outer,
    )
    return added.filter("gaps > 0").select(
        "line",
        *[(F.col(name) + F.col(f"_{n}")).alias(name) for n, name in enumerate(names[:2])],
        F.round(F.greatest(names[2], "_2"), 1).alias(names[2]),
    )


def coverage_of_days(days: DataFrame) -> DataFrame:
    """:func:`coverage` from :func:`day_gaps`."""
    return days.groupBy("line").agg(
        F.min("first_min").alias("first_min"),
        F.max("last_min").alias("last_min"),
        F.sum("minutes_with_data").alias("minutes_with_data"),
        F.sum("total_records").alias("total_records"),
    )


def heartbeat(freshness: DataFrame) -> DataFrame:
    """Minute × line matrix of records over every line of the mart; minutes a line did not report stay null."""
    return freshness.groupBy("minute_ts").pivot("line").sum("records")


def heartbeat_series(freshness: DataFrame) -> DataFrame:
    """Line, minute as text and records, for charts."""
    return freshness.select("line", F.col("minute_ts").cast("string").alias("minute_ts"), "records")
