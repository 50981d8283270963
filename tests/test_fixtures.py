"""Hand-made inputs with answers worked out by hand."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from steadyline.functions.clock import clock_text_seconds, minute_of, wall_seconds
from steadyline.functions.identity import event_id_col
from steadyline.functions.labels import day_type_col, time_band_col, week_tag_col
from steadyline.operators.arrivals import arrival_runs, extract_arrivals, section_traversal
from steadyline.operators.delay import missing_timetable, nearest_schedule, timetable_grid
from steadyline.operators.events import latest_per_key, normalize_events, parse_raw, valid_positions
from steadyline.operators.freshness import freshness_mart, gap_summary, minute_gaps
from steadyline.operators.headways import headway_mart, headways
from steadyline.operators.serving import bi_filter, cv_matrix, top_unstable
from steadyline.sources.payloads import line_stations, parse_position_payloads, to_keyed_json

LOG = (
    "seq BIGINT, line STRING, train_no STRING, statn_id STRING, statn_nm STRING, statn_tnm STRING, "
    "updn_line STRING, recptn_dt STRING"
)
ARRIVALS = "line STRING, statn_id STRING, statn_nm STRING, updn_line STRING, arrival_ts TIMESTAMP_NTZ"


def log(spark, *polls):
    """polls: (train, station, receive time)"""
    rows = [
        (i, "2호선", train, station, f"name {station}", "end", "0", when)
        for i, (train, station, when) in enumerate(polls)
    ]
    return spark.createDataFrame(rows, LOG)


def at(seconds: int) -> datetime:
    return datetime(2024, 1, 1, 8) + timedelta(seconds=seconds)


def arrivals(spark, *seconds, updn="0"):
    rows = [("2호선", "S1", "one", updn, at(s)) for s in seconds]
    return spark.createDataFrame(rows, ARRIVALS)


REPEATED = (
    ("T", "A", "2024-01-01 08:00:00"),
    ("T", "A", "2024-01-01 08:00:30"),
    ("T", "B", "2024-01-01 08:02:00"),
    ("T", "B", "2024-01-01 08:02:30"),
    ("T", "A", "2024-01-01 08:05:00"),
)


@pytest.mark.parametrize("bucket_sec", [1, 60, 900, 10**9])
def test_repeated_polls(spark, bucket_sec):
    want = [("A", "08:00:00"), ("B", "08:02:00"), ("A", "08:05:00")]
    found = extract_arrivals(log(spark, *REPEATED), bucket_sec=bucket_sec)
    got = [(r.statn_id, str(r.arrival_ts.time())) for r in found.orderBy("arrival_ts").collect()]
    assert got == want
    runs = arrival_runs(log(spark, *REPEATED), bucket_sec=bucket_sec).orderBy("arrival_ts").collect()
    assert [(r.statn_id, str(r.arrival_ts.time())) for r in runs] == want
    assert [(str(r.last_ts.time()), r.polls) for r in runs] == [
        ("08:00:30", 2),
        ("08:02:30", 2),
        ("08:05:00", 1),
    ]


def test_traversal(spark):
    found = section_traversal(extract_arrivals(log(spark, *REPEATED))).orderBy("arrival_ts")
    assert [(r.from_statn_id, r.to_statn_id, r.traversal_sec) for r in found.collect()] == [
        ("A", "B", 120),
        ("B", "A", 180),
    ]


def test_vanishing_train(spark):
    assert extract_arrivals(log(spark, ("T", "A", "2024-01-01 08:00:00"))).count() == 1


def test_train_reused_next_day(spark):
    polls = log(spark, ("T", "A", "2024-01-01 23:50:00"), ("T", "A", "2024-01-02 06:00:00"))
    assert extract_arrivals(polls).count() == 1
    assert extract_arrivals(polls, keys=("line", "train_no", "dt")).count() == 2


def test_receive_time_filter(spark):
    polls = log(spark, ("T", "A", ""), ("T", "A", None), ("T", "A", "not a time"))
    kept = valid_positions(polls).collect()
    assert [(r.recptn_dt, r.recptn_ts) for r in kept] == [("not a time", None)]
    assert extract_arrivals(polls).count() == 0


def test_equal_times_follow_sequence(spark):
    when = "2024-01-01 08:00:00"
    polls = log(spark, ("T", "A", when), ("T", "B", when), ("T", "B", when), ("T", "A", when))
    found = extract_arrivals(polls).orderBy("seq")
    assert [(r.seq, r.statn_id) for r in found.collect()] == [(0, "A"), (1, "B"), (3, "A")]


def test_headway_limits(spark):
    found = headways(arrivals(spark, 0, 0, 100, 1000, 1901)).orderBy("arrival_ts")
    assert [r.headway_sec for r in found.collect()] == [100, 900]


def test_headway_across_bucket_borders(spark):
    # Buckets are 16 cutoffs wide: cutoff 1 puts a border at every multiple of 16 seconds.
    found = headways(arrivals(spark, *range(64)), max_headway_sec=1)
    assert found.count() == 63


def test_second_precision(spark):
    rows = [
        ("2호선", "S1", "one", "0", datetime(2024, 1, 1, 8, 0, 10, us))
        for us in (200_000, 700_000)
    ]
    rows.append(("2호선", "S1", "one", "0", datetime(2024, 1, 1, 8, 0, 11, 100_000)))
    found = headways(spark.createDataFrame(rows, ARRIVALS)).collect()
    assert [(r.headway_sec, r.arrival_ts.second) for r in found] == [(1, 11)]


def test_unknown_direction_is_left_out(spark):
    assert headways(arrivals(spark, 0, 100, updn="2")).count() == 0


def test_one_sample_group(spark):
    (row,) = headway_mart(arrivals(spark, 0, 120)).collect()
    assert (row.headway_samples, row.std_sec, row.cv, row.over_1p5x_ratio) == (1, None, None, 0.0)


def test_even_group(spark):
    (row,) = headway_mart(arrivals(spark, 0, 100, 300, 600, 1000)).collect()
    assert row.asDict() == {
        "line": "2호선",
        "statn_id": "S1",
        "statn_nm": "one",
        "direction": "상행",
        "time_band": "출근",
        "day_type": "평일",
        "headway_samples": 4,
        "p50_sec": 200,
        "p90_sec": 400,
        "mean_sec": 250.0,
        "std_sec": 129.1,
        "cv": 0.516,
        "over_1p5x_ratio": 0.25,
    }


def test_null_key_drops_from_the_mart_only(spark):
    rows = [(None, "S1", "one", "0", at(0)), (None, "S1", "one", "0", at(60))]
    df = spark.createDataFrame(rows, ARRIVALS)
    assert headways(df).count() == 1
    assert headway_mart(df).count() == 0


def test_extra_key_separates_express(spark):
    df = arrivals(spark, 0, 100, 200, 300).withColumn(
        "direct_at", (F.unix_timestamp("arrival_ts") % 200 / 100).cast("int").cast("string")
    )
    rows = headway_mart(df, extra_keys=("direct_at",)).orderBy("direct_at").collect()
    assert [(r.direct_at, r.headway_samples, r.p50_sec) for r in rows] == [("0", 1, 200), ("1", 1, 200)]


def _times(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t STRING").select(
        "t", F.col("t").cast("timestamp_ntz").alias("ts")
    )


def test_band_edges(spark):
    clock = ("06:59:59", "07:00:00", "09:59:59", "10:00:00", "16:59:59", "17:00:00", "19:59:59",
             "20:00:00", "04:59:59", "05:00:00")
    df = _times(spark, *[f"2024-01-05 {c}" for c in clock]).select(time_band_col("ts").alias("b"))
    assert [r.b for r in df.collect()] == [
        "새벽", "출근", "출근", "점심", "점심", "퇴근", "퇴근", "밤", "밤", "새벽"
    ]


def test_day_types(spark):
    df = _times(spark, "2024-01-05 00:00:00", "2024-01-06 12:00:00", "2024-01-07 23:59:59")
    got = df.select(day_type_col("ts").alias("d"), week_tag_col("ts").alias("w")).collect()
    assert [(r.d, r.w) for r in got] == [("평일", "1"), ("토요일", "2"), ("휴일", "3")]


def test_clock_ignores_the_session_zone(spark):
    # 02:30 does not exist in New York on this date.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = _times(spark, "2024-03-10 02:30:15.25", "2024-03-10 03:30:15")
        rows = df.select(
            wall_seconds("ts").alias("s"), minute_of("ts").cast("string").alias("m")
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert rows[1].s - rows[0].s == 3600
    assert [r.m for r in rows] == ["2024-03-10 02:30:00", "2024-03-10 03:30:00"]


def test_clock_text(spark):
    df = spark.createDataFrame([("08:10:05",), ("24:00:01",), ("",), ("x",), (None,)], "t STRING")
    assert [r.s for r in df.select(clock_text_seconds("t").alias("s")).collect()] == [
        29405, 86401, None, None, None,
    ]


def test_gaps(spark):
    rows = [("2호선", datetime(2024, 1, 1, 8 + m // 60, m % 60), 1) for m in (0, 1, 3, 33, 64)]
    df = spark.createDataFrame(rows, "line STRING, minute_ts TIMESTAMP_NTZ, records BIGINT")
    gaps = [r.gap_min for r in minute_gaps(df).orderBy("minute_ts").collect()]
    assert gaps == [None, 1.0, 2.0, 30.0, 31.0]
    (row,) = gap_summary(df).collect()
    assert (row.window_boundaries, row.within_window_hiccups, row.max_hiccup_min) == (1, 2, 30.0)


def test_freshness_zone(spark):
    rows = [("2호선", "T", "2024-01-01 09:00:00", datetime(2024, 1, 1, 0, 0, 5))]
    df = spark.createDataFrame(
        rows, "line STRING, train_no STRING, recptn_dt STRING, ingested_at TIMESTAMP_NTZ"
    )
    (row,) = freshness_mart(df, source_tz="Asia/Tokyo").collect()
    assert row.ingest_lag_avg_sec == 5.0
    (row,) = freshness_mart(df.withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))).collect()
    assert row.ingest_lag_avg_sec == 5.0 - 9 * 3600


def test_unparseable_time_gets_a_null_minute(spark):
    rows = [("2호선", "T", "not a time", datetime(2024, 1, 1))]
    df = spark.createDataFrame(
        rows, "line STRING, train_no STRING, recptn_dt STRING, ingested_at TIMESTAMP_NTZ"
    )
    (row,) = freshness_mart(df).collect()
    assert (row.minute_ts, row.records, row.ingest_lag_avg_sec) == (None, 1, None)


def test_event_id(spark):
    df = spark.createDataFrame(
        [("T", None, "1", "2024-01-01 08:00:00"), (None, None, None, None)],
        "train_no STRING, statn_id STRING, train_sttus STRING, recptn_dt STRING",
    )
    assert [r.e for r in df.select(event_id_col().alias("e")).collect()] == ["T--1-2024-01-01", "---"]


def test_api_codes(spark):
    listed = '"realtimePositionList":[{"trainNo":"T1","recptnDt":"2024-01-01 08:00:00"}]'
    payloads = [
        ("ok", '{"errorMessage":{"code":"INFO-000"},' + listed + "}"),
        ("empty", '{"errorMessage":{"code":"INFO-200"}}'),
        ("error", '{"errorMessage":{"code":"ERROR-300","message":"bad key"}}'),
        ("plain", "{" + listed + "}"),
        ("none", "{}"),
        ("broken", '{"realtimePositionList":['),
    ]
    rows, errors = parse_position_payloads(spark.createDataFrame(payloads, "line STRING, payload STRING"))
    assert sorted(r.line for r in rows.collect()) == ["ok", "plain"]
    assert sorted((r.line, r.code, r.message) for r in errors.collect()) == [
        ("broken", None, "unreadable payload"),
        ("error", "ERROR-300", "bad key"),
    ]
    event = normalize_events(rows.filter("line = 'ok'")).first()
    assert (event.event_id, event.line, event.statn_id) == ("T1---2024-01-01", "ok", None)
    assert event.ingested_at.endswith("+00:00")


def test_keyed_json(spark):
    df = spark.createDataFrame([("T", None, '한"글')], "train_no STRING, a STRING, b STRING")
    assert to_keyed_json(df).first() == ("T", '{"train_no":"T","a":null,"b":"한\\"글"}')
    assert to_keyed_json(df, "").first().key is None
    assert to_keyed_json(df, "a").first().key is None


def test_raw_parse(spark):
    raw = [
        '{"event_id":"a","line":{"x":1},"subway_id":[1],"train_no":"{x","statn_id":5,"statn_nm":true}',
        '{"event_id":"b","line":',
        '{"event_id":{"a":1}}',
        '{"event_id":null}',
        "[1]",
        "",
        None,
    ]
    rows = parse_raw(spark.createDataFrame([(r,) for r in raw], "value STRING")).collect()
    assert [(r.event_id, r.line, r.subway_id, r.train_no, r.statn_id, r.statn_nm) for r in rows] == [
        ("a", None, None, "{x", "5", "true")
    ]
    assert rows[0].raw_json == raw[0]


def test_latest_row_is_the_last_to_arrive(spark):
    rows = [("k", "2024-01-01 09:00:00", 1), ("k", "2024-01-01 08:00:00", 2)]
    df = spark.createDataFrame(rows, "event_id STRING, recptn_dt STRING, seq BIGINT")
    assert [r.seq for r in latest_per_key(df).collect()] == [2]


def test_nearest_schedule(spark):
    seen = [
        (i, "0", "A", datetime(2024, 1, 1, 8, m)) for i, m in enumerate((4, 5, 9))
    ] + [(3, "0", "A", datetime(2024, 1, 1, 7, 50)), (4, "1", "A", datetime(2024, 1, 1, 8, 4))]
    df = spark.createDataFrame(
        seen, "seq BIGINT, updn_line STRING, statn_nm STRING, arrival_ts TIMESTAMP_NTZ"
    )
    planned = spark.createDataFrame(
        [("A", "1", "1", "08:00:00"), ("A", "1", "1", "08:10:00"), ("A", "2", "1", "08:04:00"),
         ("A", "1", "1", "")],
        "station_nm STRING, week_tag STRING, inout_tag STRING, arrive_time STRING",
    )
    found = nearest_schedule(df, planned).orderBy("seq").collect()
    assert [(r.seq, r.delay_sec) for r in found] == [(0, 240), (1, 300), (2, -60), (3, -600)]


@pytest.mark.parametrize("written", ["24:09:00", "00:09:00"])
def test_service_day_runs_past_midnight(spark, written):
    """Saturday 00:10 still belongs to Friday; Friday 03:30 does not belong to Thursday."""
    seen = [(0, "0", "A", datetime(2024, 1, 6, 0, 10)), (1, "0", "A", datetime(2024, 1, 5, 3, 30))]
    df = spark.createDataFrame(
        seen, "seq BIGINT, updn_line STRING, statn_nm STRING, arrival_ts TIMESTAMP_NTZ"
    )
    planned = spark.createDataFrame(
        [("A", "1", "1", written), ("A", "1", "1", "05:30:00"), ("A", "2", "1", "00:10:00")],
        "station_nm STRING, week_tag STRING, inout_tag STRING, arrive_time STRING",
    )
    found = nearest_schedule(df, planned).orderBy("seq").collect()
    assert [(r.seq, r.delay_sec) for r in found] == [(0, 60), (1, -7200)]


def test_stations_and_grid(spark):
    page = (
        '{"SearchSTNBySubwayLineInfo":{"row":['
        '{"STATION_CD":"2","FR_CODE":"9","STATION_NM":"old","LINE_NUM":"09호선"},'
        '{"STATION_CD":"1","STATION_NM":"first","LINE_NUM":"09호선"},'
        '{"STATION_CD":"3","STATION_NM":"other","LINE_NUM":"08호선"},'
        '{"STATION_CD":"2","FR_CODE":"8","STATION_NM":"new","LINE_NUM":"09호선"}]}}'
    )
    pages = spark.createDataFrame([(0, page)], "seq BIGINT, payload STRING")
    stations = line_stations(pages, "09호선")
    assert [tuple(r) for r in stations.collect()] == [("1", "", "first"), ("2", "8", "new")]
    assert timetable_grid(stations).count() == 12
    known = spark.createDataFrame(
        [("1", "1", "1")], "station_cd STRING, week_tag STRING, inout_tag STRING"
    )
    assert missing_timetable(stations, known).count() == 11


MART = (
    "line STRING, statn_id STRING, statn_nm STRING, direction STRING, time_band STRING, "
    "day_type STRING, headway_samples BIGINT, p50_sec BIGINT, p90_sec BIGINT, cv DOUBLE, "
    "over_1p5x_ratio DOUBLE"
)


def test_serving(spark):
    rows = [
        ("1호선", "S1", "a", "상행", "출근", "평일", 20, 100, 200, 0.5, 0.1),
        ("1호선", "S2", "b", "상행", "출근", "평일", 20, 100, 200, 0.5, 0.1),
        ("2호선", "S3", "c", "하행", "점심", "평일", 20, 100, 200, 0.9, 0.1),
        ("2호선", "S4", "d", "하행", "퇴근", "평일", 3, 100, 200, 2.0, 0.1),
        ("2호선", "S5", "e", "하행", "퇴근", "평일", 8, 100, 200, None, 0.1),
    ]
    mart = spark.createDataFrame(rows, MART)
    assert [r.statn_nm for r in top_unstable(mart).collect()] == ["a", "b", "e"]
    assert bi_filter(mart, "(전체)", "(전체)").count() == 3
    assert bi_filter(mart, "2호선", None, 3).count() == 3
    matrix = {r.line: r.asDict() for r in cv_matrix(mart).collect()}
    assert matrix["1호선"]["출근"] == 0.5
    assert matrix["2호선"]["퇴근"] == 0.0
