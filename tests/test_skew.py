"""Bucketed operators against plain windows, with one key holding a third of all rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from steadyline.operators.arrivals import arrival_runs, extract_arrivals, section_traversal
from steadyline.operators.delay import nearest_schedule
from steadyline.operators.headways import headways, with_group_median
from steadyline.operators.statistics import spread

START = datetime(2024, 1, 1, 5)


@pytest.fixture(scope="module")
def polls(spark):
    rng = random.Random(7)
    rows = []
    for seq in range(6000):
        hot = rng.random() < 1 / 3
        train = "" if hot else f"T{rng.randrange(40)}"
        if rng.random() < 0.01:
            train = None
        station = f"S{0 if rng.random() < 1 / 3 else rng.randrange(6)}"
        when = START + timedelta(seconds=rng.randrange(3 * 86_400))
        if rng.random() < 0.2:
            when = when.replace(minute=0, second=0)  # many equal times
        rows.append((seq, rng.choice("12") + "호선", train, station, "n" + station, "end",
                     rng.choice("01"), str(when)))
    schema = ("seq BIGINT, line STRING, train_no STRING, statn_id STRING, statn_nm STRING, "
              "statn_tnm STRING, updn_line STRING, recptn_dt STRING")
    return spark.createDataFrame(rows, schema).persist()


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    right = right.select(*left.columns)
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


@pytest.mark.parametrize("bucket_sec", [1, 300, 900, 20_000, 10**9])
def test_arrivals(spark, polls, bucket_sec):
    rows = polls.withColumn("arrival_ts", F.col("recptn_dt").cast("timestamp_ntz"))
    order = Window.partitionBy("train_no").orderBy("arrival_ts", "seq")
    plain = (
        rows.withColumn("_prev", F.lag("statn_id").over(order))
        .filter("_prev IS NULL OR _prev <> statn_id")
        .withColumn("dt", F.col("arrival_ts").cast("date").cast("string"))
        .drop("_prev", "recptn_dt")
    )
    same(extract_arrivals(polls, bucket_sec=bucket_sec), plain)


@pytest.mark.parametrize("bucket_sec", [1, 300, 900, 20_000, 10**9])
def test_runs(spark, polls, bucket_sec):
    rows = polls.withColumn("ts", F.col("recptn_dt").cast("timestamp_ntz"))
    order = Window.partitionBy("train_no").orderBy("ts", "seq")
    starts = F.when(F.col("statn_id").eqNullSafe(F.lag("statn_id").over(order)), 0).otherwise(1)
    plain = (
        rows.withColumn("_starts", starts)
        .withColumn("_run", F.sum("_starts").over(order))
        .groupBy("train_no", "_run")
        .agg(
            F.min_by("seq", F.struct("ts", "seq")).alias("seq"),
            F.max("ts").alias("last_ts"),
            F.count(F.lit(1)).alias("polls"),
        )
        .drop("_run")
    )
    runs = arrival_runs(polls, bucket_sec=bucket_sec)
    same(runs.select("train_no", "seq", "last_ts", "polls"), plain)
    found = extract_arrivals(polls, bucket_sec=bucket_sec)
    same(runs.drop("last_ts", "polls").select(*found.columns), found)
    assert runs.agg(F.sum("polls")).first()[0] == polls.count()


def test_traversal(spark, polls):
    found = extract_arrivals(polls)
    order = Window.partitionBy("train_no", "dt").orderBy("arrival_ts", "seq")
    plain = found.select(
        "train_no", "arrival_ts", F.lag("statn_id").over(order).alias("from_statn_id"),
        F.lag("arrival_ts").over(order).alias("depart_ts"), "statn_id",
    ).filter("depart_ts IS NOT NULL").withColumnRenamed("statn_id", "to_statn_id")
    got = section_traversal(found).select(*plain.columns)
    same(got, plain)


@pytest.mark.parametrize("cutoff", [30, 900, 43_200])
def test_headways(spark, polls, cutoff):
    found = extract_arrivals(polls)
    order = Window.partitionBy("line", "statn_id", "updn_line").orderBy("arrival_ts", "statn_nm")
    gap = F.unix_timestamp("arrival_ts") - F.unix_timestamp(F.lag("arrival_ts").over(order))
    plain = (
        found.select("line", "statn_id", "arrival_ts", gap.alias("headway_sec"))
        .filter(f"headway_sec BETWEEN 1 AND {cutoff}")
    )
    same(headways(found, cutoff).select(*plain.columns), plain)


def test_spread_equals_direct_aggregates(spark, polls):
    rows = headways(extract_arrivals(polls), 3600)
    keys = ["line", "statn_id"]
    direct = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("headway_sec", 0.5).alias("p50"),
        F.percentile_approx("headway_sec", 0.9).alias("p90"),
        F.round(F.avg("headway_sec"), 6).alias("mean"),
        F.round(F.stddev("headway_sec"), 6).alias("std"),
    )
    got = spread(rows, keys, "headway_sec").drop("over").withColumns(
        {"mean": F.round("mean", 6), "std": F.round("std", 6)}
    )
    same(got, direct)
    over = with_group_median(rows, keys).groupBy(*keys).agg(
        F.round(F.avg((F.col("headway_sec") > 1.5 * F.col("grp_p50")).cast("int")), 9).alias("over")
    )
    same(spread(rows, keys, "headway_sec").select(*keys, F.round("over", 9).alias("over")), over)


def test_nearest_schedule_equals_pairwise(spark, polls):
    found = extract_arrivals(polls)
    rng = random.Random(3)
    planned = {
        (f"nS{rng.randrange(6)}", rng.choice("123"), rng.choice("12"),
         f"{rng.randrange(24):02}:{rng.randrange(60):02}:{rng.randrange(60):02}")
        for _ in range(400)
    }
    timetable = spark.createDataFrame(
        sorted(planned), "station_nm STRING, week_tag STRING, inout_tag STRING, arrive_time STRING"
    )
    by_service = {}
    for station, week, inout, clock in planned:
        h, m, s = map(int, clock.split(":"))
        by_service.setdefault((station, week, inout), []).append((h + 24 * (h < 3)) * 3600 + m * 60 + s)
    want = {}
    for r in found.collect():
        early = r.arrival_ts.hour < 3  # still the service day before
        day = (r.arrival_ts.weekday() - early) % 7
        service = (r.statn_nm, "3" if day == 6 else "2" if day == 5 else "1", str(int(r.updn_line) + 1))
        t = r.arrival_ts.hour * 3600 + r.arrival_ts.minute * 60 + r.arrival_ts.second + early * 86400
        if service in by_service:
            best = min(by_service[service], key=lambda s: (abs(s - t), s))
            want[r.seq] = t - best
    got = {r.seq: r.delay_sec for r in nearest_schedule(found, timetable).collect()}
    assert got == want
