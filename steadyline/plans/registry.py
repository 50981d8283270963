"""Every operator as a query over the driver's tables: ``name → (spark, sf_dir) → DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from steadyline.functions import labels as L
from steadyline.functions.clock import date_text, minute_of, wall_clock
from steadyline.functions.identity import event_id_col, text_date_col
from steadyline.operators import arrivals as arr
from steadyline.operators import delay, events, freshness, serving
from steadyline.operators import headways as hw
from steadyline.plans import adapter, marts, medallion
from steadyline.plans.adapter import LATE_SEC, WIDE_CUTOFF_SEC
from steadyline.session import shared_folder
from steadyline.sources import payloads, tables
from steadyline.sources.timetable_csv import read_timetable, write_timetable
from steadyline.streaming import bronze

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def _fresh(name: str) -> str:
    """A catalog name that no other run uses."""
    return f"{name}_{uuid.uuid4().hex}"


def _arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return arr.extract_arrivals(adapter.positions(spark, sf), extra=("direct_at",))


def _headways(spark: SparkSession, sf: str) -> DataFrame:
    return hw.headways(_arrivals(spark, sf), WIDE_CUTOFF_SEC)


def _mart(spark: SparkSession, sf: str) -> DataFrame:
    return hw.headway_mart(_arrivals(spark, sf), WIDE_CUTOFF_SEC)


def _explore(spark: SparkSession, sf: str) -> DataFrame:
    return hw.headway_explore(_arrivals(spark, sf), max_headway_sec=WIDE_CUTOFF_SEC)


def _freshness(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.freshness_mart(adapter.positions(spark, sf))


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    return delay.nearest_schedule(_arrivals(spark, sf), adapter.timetable(spark, sf))


def _delays(spark: SparkSession, sf: str) -> DataFrame:
    return delay.arrival_delay(_matched(spark, sf), LATE_SEC)


def _stamped(spark: SparkSession, sf: str) -> DataFrame:
    return events.bronze_log(adapter.raw_records(spark, sf))


# ---- sources and sinks -----------------------------------------------------------------------


@_query("read_position_api")
def _(spark, sf):
    return payloads.parse_position_payloads(adapter.position_payloads(spark, sf))[0]


@_query("read_position_api_errors")
def _(spark, sf):
    return payloads.parse_position_payloads(adapter.position_payloads(spark, sf))[1]


def _landed(spark: SparkSession, sf: str) -> str:
    """The raw records as landed files for the file-stream source."""
    path = shared_folder(spark, "landed")
    adapter.raw_records(spark, sf).write.parquet(path)
    return path


def _drained(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Both bronze tables after the stream has consumed the landed files."""
    source = bronze.read_events(
        spark, "parquet", _landed(spark, sf), "seq BIGINT, value STRING"
    )
    log, current = shared_folder(spark, "log"), shared_folder(spark, "current")
    query = bronze.start_bronze(
        source,
        log,
        current,
        shared_folder(spark, "progress"),
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    return log, current


@_query("stream_source")
def _(spark, sf):
    out = shared_folder(spark, "streamed")
    source = bronze.read_events(
        spark, "parquet", _landed(spark, sf), "seq BIGINT, value STRING"
    )
    (
        source.writeStream.format("parquet")
        .option("checkpointLocation", shared_folder(spark, "progress"))
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )
    return spark.read.schema("seq BIGINT, value STRING").parquet(out)


@_query("keyed_json_records")
def _(spark, sf):
    return adapter.keyed_events(spark, sf)


_STORED = ("seq", *events.RECORD_FIELDS)


@_query("append_log")
def _(spark, sf):
    path = shared_folder(spark, "log")
    for _delivery in range(2):  # the batch is delivered twice
        bronze.write_position_log(_stamped(spark, sf), 0, path)
    return bronze.read_position_log(spark, path).select(*_STORED, "dt", "batch_id")


@_query("upsert_current")
def _(spark, sf):
    path = shared_folder(spark, "current")
    for _delivery in range(2):
        bronze.upsert_current(_stamped(spark, sf), path)
    return bronze.read_current(spark, path).select(*_STORED)


@_query("mart_create_or_replace")
def _(spark, sf):
    name, location = f"{_fresh('steadyline_gold')}.freshness", shared_folder(spark, "mart")
    mart = _freshness(spark, sf)
    namespace, gold = name.split(".")[0], shared_folder(spark, "gold")
    spark.sql(f"CREATE NAMESPACE {namespace} LOCATION '{gold}'")
    tables.save_mart(mart.filter("records > 1"), name, location)
    return tables.save_mart(mart, name, location)


@_query("l1_idempotent_write")
def _(spark, sf):
    path = shared_folder(spark, "arrivals")
    found = arr.extract_arrivals(adapter.positions(spark, sf))
    for _run in range(2):
        tables.write_arrivals(found, path)
    return tables.read_arrivals(spark, path, found.schema)


@_query("timetable_read_api")
def _(spark, sf):
    return payloads.parse_timetable_payloads(adapter.timetable_payloads(spark, sf))


@_query("station_list")
def _(spark, sf):
    return payloads.line_stations(adapter.station_payloads(spark, sf), "09호선")


@_query("timetable_csv")
def _(spark, sf):
    path = shared_folder(spark, "timetable")
    write_timetable(adapter.timetable(spark, sf), path)
    return read_timetable(spark, path)


@_query("export_csv")
def _(spark, sf):
    names = ["seq", "line", "train_no", "statn_id", "statn_nm", "updn_line", "recptn_dt"]
    view, out = _fresh("steadyline_export"), shared_folder(spark, "export")
    rows = adapter.positions(spark, sf).select(*names)
    rows.withColumn("raw_json", F.lit("{}")).createOrReplaceTempView(view)
    tables.export_tables(spark, {"log": view, "absent": _fresh("steadyline_absent")}, out)
    return spark.read.csv(f"{out}/log", header=True, escape='"').select(*names)


# Rows of these days that come late: a third of them, and the days that are built again for them.
_LATE_DAYS = ("2024-01-05", "2024-01-08")


def _dated(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The log with its dates, without the late rows and with them."""
    log = adapter.positions(spark, sf).withColumn("dt", text_date_col())
    late = F.col("dt").between(*_LATE_DAYS) & (F.col("seq") % 3 == 0)
    return log.filter(~F.coalesce(late, F.lit(False))), log


@_query("arrivals_incremental")
def _(spark, sf):
    """The days of late rows are built again, then the last days."""
    path = shared_folder(spark, "arrivals")
    early, log = _dated(spark, sf)
    medallion.build_arrivals(early, path)
    medallion.build_arrivals(log, path, dt_from=_LATE_DAYS[0], dt_to=_LATE_DAYS[1])
    medallion.build_arrivals(log, path, dt_from="2024-01-25")
    return tables.read_arrivals(spark, path, arr.extract_arrivals(log).schema)


@_query("headway_mart_incremental")
def _(spark, sf):
    """Counts by date; the dates that late rows changed are counted again and the mart is added up."""
    path, counts = shared_folder(spark, "arrivals"), shared_folder(spark, "headway-counts")
    early, log = _dated(spark, sf)
    medallion.build_arrivals(early, path, extra=("direct_at",))
    arrivals = medallion.stored_arrivals(spark, path)
    marts.build_headway_counts(arrivals, counts, WIDE_CUTOFF_SEC)
    dates = medallion.build_arrivals(log, path, extra=("direct_at",), dt_from=_LATE_DAYS[0], dt_to=_LATE_DAYS[1])
    marts.build_headway_counts(medallion.stored_arrivals(spark, path), counts, WIDE_CUTOFF_SEC, dates=dates)
    return hw.mart_of_counts(marts.stored_headway_counts(spark, counts))


def _freshness_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Stored parts of the freshness mart, some dates of which were built again for late rows."""
    path = shared_folder(spark, "freshness-parts")
    early, log = _dated(spark, sf)
    marts.build_freshness_parts(early, path)
    days = [f"2024-01-{day:02}" for day in range(5, 9)]
    marts.build_freshness_parts(log, path, dates=days)
    return marts.stored_freshness_parts(spark, path)


@_query("freshness_mart_incremental")
def _(spark, sf):
    return freshness.mart_of_parts(_freshness_parts(spark, sf))


@_query("coverage_incremental")
def _(spark, sf):
    return freshness.coverage_of_days(marts.freshness_days(_freshness_parts(spark, sf)))


@_query("gap_summary_incremental")
def _(spark, sf):
    return freshness.gaps_of_days(marts.freshness_days(_freshness_parts(spark, sf)))


@_query("table_scan_count")
def _(spark, sf):
    view = _fresh("steadyline_log")
    adapter.positions(spark, sf).createOrReplaceTempView(view)
    return tables.scan_count(spark, view, "log_rows")


# ---- projections, filters, scalar functions --------------------------------------------------


@_query("normalize_event")
def _(spark, sf):
    return events.normalize_events(
        adapter.api_rows(spark, sf), F.col("ingested_at").cast("string")
    ).drop("ingested_at")


@_query("event_id")
def _(spark, sf):
    return adapter.positions(spark, sf).select("seq", event_id_col().alias("event_id"))


@_query("json_extract")
def _(spark, sf):
    return events.parse_raw(adapter.raw_records(spark, sf))


@_query("valid_event_filter")
def _(spark, sf):
    return events.parse_raw(adapter.raw_records(spark, sf)).select("seq")


@_query("dt_partition_col")
def _(spark, sf):
    rows = adapter.positions(spark, sf).withColumn("recptn_ts", wall_clock("recptn_dt"))
    return rows.select(
        "seq", text_date_col().alias("log_dt"), date_text("recptn_ts").alias("arrival_dt")
    )


@_query("ingest_stamp")
def _(spark, sf):
    return _stamped(spark, sf).agg(
        F.count(F.lit(1)).alias("records"),
        F.count("ingested_at").alias("stamped"),
        (F.min("ingested_at") == F.max("ingested_at")).alias("one_stamp"),
    )


@_query("receive_ts_filter")
def _(spark, sf):
    return events.valid_positions(adapter.positions(spark, sf)).select("seq", "recptn_ts")


@_query("direction_label")
def _(spark, sf):
    return adapter.positions(spark, sf).select(
        "seq", "updn_line", L.direction_col().alias("direction")
    )


@_query("time_band_label")
def _(spark, sf):
    return adapter.events(spark, sf).select("event_id", L.time_band_col("ts").alias("time_band"))


@_query("day_type_label")
def _(spark, sf):
    return adapter.events(spark, sf).select("event_id", L.day_type_col("ts").alias("day_type"))


@_query("week_tag_map")
def _(spark, sf):
    rows = adapter.positions(spark, sf).withColumn("recptn_ts", wall_clock("recptn_dt"))
    return rows.select(
        "seq",
        L.week_tag_col("recptn_ts").alias("week_tag"),
        L.inout_tag_col().alias("inout_tag"),
    )


@_query("minute_trunc")
def _(spark, sf):
    return adapter.events(spark, sf).select("event_id", minute_of("ts").alias("minute_ts"))


@_query("bi_filters")
def _(spark, sf):
    return serving.bi_filter(_mart(spark, sf), line="2호선", band="출근", min_n=10)


@_query("display_label")
def _(spark, sf):
    return _mart(spark, sf).select("line", L.label_col().alias("label"), "day_type", "cv")


@_query("minute_text")
def _(spark, sf):
    return freshness.heartbeat_series(_freshness(spark, sf))


@_query("numeric_scalars")
def _(spark, sf):
    found = _headways(spark, sf)
    return found.select(
        "line",
        "arrival_ts",
        F.round(F.col("headway_sec") / 7, 3).alias("rounded"),
        F.nullif(F.col("headway_sec") % 5, F.lit(0)).alias("without_zero"),
        F.when(F.col("headway_sec") > 1800, 1).otherwise(0).alias("is_long"),
    )


# ---- joins -----------------------------------------------------------------------------------


@_query("median_self_join")
def _(spark, sf):
    return hw.with_group_median(_headways(spark, sf))


@_query("nearest_scheduled")
def _(spark, sf):
    return _matched(spark, sf).select(
        "seq", "station_nm", "week_tag", "inout_tag", "actual_sec", "scheduled_sec", "delay_sec"
    )


@_query("station_day_direction_grid")
def _(spark, sf):
    stations = payloads.line_stations(adapter.station_payloads(spark, sf), "09호선")
    return delay.timetable_grid(stations)


@_query("missing_timetable")
def _(spark, sf):
    stations = payloads.line_stations(adapter.station_payloads(spark, sf), "09호선")
    return delay.missing_timetable(stations, adapter.timetable(spark, sf))


# ---- windows ---------------------------------------------------------------------------------


@_query("arrivals_lag")
def _(spark, sf):
    return _arrivals(spark, sf)


@_query("arrivals_lag_by_day")
def _(spark, sf):
    return arr.extract_arrivals(
        adapter.positions(spark, sf), keys=("line", "train_no", "dt")
    )


@_query("arrivals_pattern")
def _(spark, sf):
    return arr.arrival_runs(adapter.positions(spark, sf))


@_query("headway")
def _(spark, sf):
    return _headways(spark, sf)


@_query("minute_gaps")
def _(spark, sf):
    return freshness.minute_gaps(_freshness(spark, sf))


@_query("section_traversal")
def _(spark, sf):
    return arr.section_traversal(_arrivals(spark, sf))


@_query("section_summary")
def _(spark, sf):
    return arr.section_summary(arr.section_traversal(_arrivals(spark, sf)))


# ---- aggregations ----------------------------------------------------------------------------


@_query("group_median")
def _(spark, sf):
    return hw.group_median(_headways(spark, sf))


@_query("headway_mart")
def _(spark, sf):
    return _mart(spark, sf)


@_query("headway_mart_default")
def _(spark, sf):
    return hw.headway_mart(_arrivals(spark, sf))


@_query("headway_notebook")
def _(spark, sf):
    return _explore(spark, sf)


@_query("freshness_mart")
def _(spark, sf):
    return _freshness(spark, sf)


@_query("coverage")
def _(spark, sf):
    return freshness.coverage(_freshness(spark, sf))


@_query("gap_summary")
def _(spark, sf):
    return freshness.gap_summary(_freshness(spark, sf))


@_query("mean_cv_by_line_band")
def _(spark, sf):
    return serving.mean_cv(_mart(spark, sf))


@_query("mean_cv_notebook")
def _(spark, sf):
    return serving.mean_cv_explore(_explore(spark, sf))


@_query("arrival_delay")
def _(spark, sf):
    return _delays(spark, sf).select(
        "seq", "station_nm", "direction", "time_band", "day_type", "delay_sec", "is_delayed"
    )


@_query("delay_by_station")
def _(spark, sf):
    return delay.delay_by_station(_delays(spark, sf))


@_query("delay_by_timeband")
def _(spark, sf):
    return delay.delay_by_timeband(_delays(spark, sf))


@_query("delay_stats")
def _(spark, sf):
    return delay.delay_by_direction(_delays(spark, sf))


@_query("rows_by_dt")
def _(spark, sf):
    return events.count_by(_stamped(spark, sf), "dt")


@_query("arrivals_by_line")
def _(spark, sf):
    return events.count_by(_arrivals(spark, sf), "line")


@_query("dedup_ratio")
def _(spark, sf):
    """The records are parsed once, into the log; both layers are counted from there."""
    path = shared_folder(spark, "log")
    _stamped(spark, sf).drop("raw_json").write.parquet(path)
    log = spark.read.parquet(path)
    return events.layer_counts(log, arr.extract_arrivals(log))


@_query("mean_cv_pivot")
def _(spark, sf):
    return serving.cv_matrix(_mart(spark, sf))


@_query("heartbeat_pivot")
def _(spark, sf):
    """The pivot looks at the mart twice, for its lines and for its cells, so it reads the stored mart."""
    path = shared_folder(spark, "freshness")
    _freshness(spark, sf).write.parquet(path)
    return freshness.heartbeat(spark.read.parquet(path))


@_query("express_split")
def _(spark, sf):
    return hw.headway_mart(_arrivals(spark, sf), WIDE_CUTOFF_SEC, extra_keys=("direct_at",))


# ---- sort, limit, top-k ----------------------------------------------------------------------


@_query("top_unstable_rush")
def _(spark, sf):
    return serving.top_unstable(_mart(spark, sf))


@_query("top_unstable_bi")
def _(spark, sf):
    return serving.top_unstable(
        serving.bi_filter(_mart(spark, sf), line=L.ALL, band=L.ALL), bands=None, n=20
    )


@_query("top_unstable_notebook")
def _(spark, sf):
    return serving.top_unstable_explore(_explore(spark, sf))


@_query("latest_positions")
def _(spark, sf):
    return serving.latest_positions(events.bronze_current(adapter.raw_records(spark, sf)))


@_query("train_sequence")
def _(spark, sf):
    return serving.train_sequence(_arrivals(spark, sf), "7")


@_query("top_delayed_stations")
def _(spark, sf):
    return serving.top_delayed(delay.delay_by_station(_delays(spark, sf)))


# ---- streaming -------------------------------------------------------------------------------


@_query("bronze_fanout_log")
def _(spark, sf):
    log, _current = _drained(spark, sf)
    return bronze.read_position_log(spark, log).select(*_STORED, "dt")


@_query("bronze_fanout_current")
def _(spark, sf):
    _log, current = _drained(spark, sf)
    return bronze.read_current(spark, current).select(*_STORED)


@_query("bronze_batch_log")
def _(spark, sf):
    return _stamped(spark, sf).drop("ingested_at")


@_query("bronze_batch_current")
def _(spark, sf):
    return events.bronze_current(adapter.raw_records(spark, sf)).drop("ingested_at")
