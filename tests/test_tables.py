"""Sinks: replays, reruns, compaction, round trips and exports."""

from __future__ import annotations

import glob
import json
import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from steadyline.__main__ import main
from steadyline.operators.arrivals import extract_arrivals
from steadyline.operators.events import bronze_current, bronze_log
from steadyline.operators import freshness, headways
from steadyline.operators.freshness import heartbeat
from steadyline.plans import incremental, marts, medallion
from steadyline.sources import tables
from steadyline.sources.payloads import TIMETABLE_COLUMNS
from steadyline.sources.timetable_csv import read_timetable, write_timetable
from steadyline.streaming import bronze

RAW = "seq BIGINT, value STRING"


def record(seq, train, station, when, status="1", **more):
    event = {
        "event_id": f"{train}-{station}-{status}-{when[:10]}",
        "line": "2호선",
        "train_no": train,
        "statn_id": station,
        "statn_nm": "n" + station,
        "updn_line": "0",
        "train_sttus": status,
        "recptn_dt": when,
        **more,
    }
    return seq, json.dumps(event, ensure_ascii=False)


DAY1 = [
    record(1, "T", "A", "2024-01-01 08:00:30"),
    record(2, "T", "A", "2024-01-01 08:00:00"),
    record(3, "U", "A", ""),
]
DAY2 = [record(4, "T", "A", "2024-01-01 09:00:00"), record(5, "T", "B", "2024-01-02 08:00:00")]


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_log_replay(spark, tmp_path):
    path = str(tmp_path / "log")
    for batch_id, rows in ((0, DAY1), (1, DAY2), (0, DAY1), (1, DAY2)):
        bronze.write_position_log(bronze_log(raw(spark, rows)), batch_id, path)
    log = bronze.read_position_log(spark, path)
    assert sorted(r.seq for r in log.collect()) == [1, 2, 3, 4, 5]
    assert sorted(d for d in os.listdir(path) if d.startswith("dt=")) == [
        "dt=2024-01-01", "dt=2024-01-02", "dt=__HIVE_DEFAULT_PARTITION__",
    ]


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "current")
    for batch_id, rows in ((0, DAY1), (1, DAY2), (0, DAY1)):
        bronze.upsert_current(bronze_log(raw(spark, rows)), path, batch_id)
    want = {"T-A-1-2024-01-01": 4, "U-A-1-": 3, "T-B-1-2024-01-02": 5}
    assert {r.event_id: r.seq for r in bronze.read_current(spark, path).collect()} == want


def _files(path):
    return sorted(glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_compaction_writes_elsewhere(spark, tmp_path):
    path, target, part = (str(tmp_path / n) for n in ("current", "new", "part"))
    for batch_id, rows in ((0, DAY1), (1, DAY2)):
        bronze.upsert_current(bronze_log(raw(spark, rows)), path, batch_id)
    before = _files(path)
    bronze.compact_current(spark, path, target)
    assert _files(path) == before
    assert {r.seq for r in bronze.read_current(spark, target).collect()} == {3, 4, 5}
    assert spark.read.parquet(target).count() == 3
    dates = spark.createDataFrame([("",), ("2024-01-02",)], "dt STRING")
    bronze.compact_current(spark, path, part, dates)
    assert {r.seq for r in bronze.read_current(spark, part).collect()} == {3, 5}


def test_compaction_of_many_dates(spark, tmp_path):
    path, target = str(tmp_path / "current"), str(tmp_path / "new")
    days = [str(date(2022, 1, 1) + timedelta(days=i)) for i in range(450)]
    rows = [record(i, "T", "A", f"{day} 08:00:00") for i, day in enumerate(days)]
    bronze.upsert_current(bronze_log(raw(spark, rows)).coalesce(1), path)
    dates = spark.createDataFrame([(day,) for day in days[10:]], "dt STRING")
    bronze.compact_current(spark, path, target, dates)
    assert {r.seq for r in bronze.read_current(spark, target).collect()} == set(range(10, 450))


def test_rebuild_from_log_restores_the_blank_date(spark, tmp_path):
    log, current, target = (str(tmp_path / n) for n in ("log", "current", "new"))
    bronze.backfill(raw(spark, DAY1 + DAY2), log, current)
    bronze.compact_current(spark, log, target)
    for path in (current, target):
        assert {r.seq for r in bronze.read_current(spark, path).collect()} == {3, 4, 5}


def _land(spark, path, rows):
    raw(spark, rows).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch(spark, tmp_path):
    landed, log, current, progress = (str(tmp_path / n) for n in ("in", "log", "cur", "chk"))
    _land(spark, landed, DAY1)

    def drain():
        source = bronze.read_events(spark, "parquet", landed, RAW, maxFilesPerTrigger="1")
        bronze.start_bronze(source, log, current, progress, {"availableNow": True}).awaitTermination()

    drain()
    _land(spark, landed, DAY2)
    _land(spark, landed, [(6, "not json"), (7, '{"line":"no id"}')])
    drain()
    drain()
    everything = raw(spark, DAY1 + DAY2)
    got = {(r.seq, r.event_id) for r in bronze.read_position_log(spark, log).collect()}
    assert got == {(r.seq, r.event_id) for r in bronze_log(everything).collect()}
    got = {(r.seq, r.event_id) for r in bronze.read_current(spark, current).collect()}
    assert got == {(r.seq, r.event_id) for r in bronze_current(everything).collect()}


def test_two_runs_keep_each_others_rows(spark, tmp_path):
    """Fresh checkpoints number their batches from 0 again; rows of one date come from both."""
    log, current = str(tmp_path / "log"), str(tmp_path / "cur")
    for run, rows in enumerate((DAY1, DAY2)):
        landed = str(tmp_path / f"in{run}")
        _land(spark, landed, rows)
        source = bronze.read_events(spark, "parquet", landed, RAW)
        bronze.start_bronze(
            source, log, current, str(tmp_path / f"chk{run}"), {"availableNow": True}
        ).awaitTermination()
    assert sorted(r.seq for r in bronze.read_position_log(spark, log).collect()) == [1, 2, 3, 4, 5]
    assert {r.seq for r in bronze.read_current(spark, current).collect()} == {3, 4, 5}


def test_text_source(spark, tmp_path):
    landed, log, current = (str(tmp_path / n) for n in ("in", "log", "cur"))
    os.mkdir(landed)
    with open(f"{landed}/a.txt", "w") as file:
        file.write("".join(value + "\n" for _, value in DAY1) + "plain\n")
    source = bronze.read_events(spark, "text", landed)
    assert source.isStreaming and source.columns == ["value"]
    bronze.start_bronze(
        source, log, current, str(tmp_path / "chk"), {"availableNow": True}
    ).awaitTermination()
    assert bronze.read_position_log(spark, log).count() == 3
    assert bronze.read_current(spark, current).count() == 2


def _polled(spark, rows):
    return bronze_log(raw(spark, rows)).withColumn("direct_at", F.lit("0"))


def test_incremental_equals_full_after_silence(spark, tmp_path):
    """A train seen at the same station again after three days has not arrived anew."""
    path = str(tmp_path / "arrivals")
    log = _polled(spark, [record(1, "T", "A", "2024-01-01 08:00:00"), record(2, "T", "A", "2024-01-04 08:00:00"),
                          record(3, "T", "B", "2024-01-04 09:00:00")])
    medallion.build_arrivals(log, path, extra=("direct_at",))
    want = sorted(map(tuple, medallion.stored_arrivals(spark, path).collect()))
    assert len(want) == 2
    medallion.build_arrivals(log, path, extra=("direct_at",), dt_from="2024-01-04")
    assert sorted(map(tuple, medallion.stored_arrivals(spark, path).collect())) == want


def test_rerun_clears_dates_without_arrivals(spark, tmp_path):
    path = str(tmp_path / "arrivals")
    log = _polled(spark, [record(1, "T", "A", "2024-01-01 08:00:00"), record(2, "T", "A", "2024-01-04 08:00:00")])
    by_day = ("line", "train_no", "dt")

    def dates():
        return sorted(r.dt for r in medallion.stored_arrivals(spark, path).collect())

    medallion.build_arrivals(log, path, by_day, extra=("direct_at",))
    assert dates() == ["2024-01-01", "2024-01-04"]
    medallion.build_arrivals(log, path, extra=("direct_at",))
    assert dates() == ["2024-01-01"]
    medallion.build_arrivals(log, path, by_day, extra=("direct_at",))
    medallion.build_arrivals(log, path, extra=("direct_at",), dt_from="2024-01-02")
    assert dates() == ["2024-01-01"]


def test_arrivals_rerun_and_date_range(spark, tmp_path):
    path = str(tmp_path / "arrivals")
    log = bronze_log(raw(spark, DAY1 + DAY2)).withColumn("direct_at", F.lit("0"))
    for _run in range(2):
        medallion.build_arrivals(log, path, extra=("direct_at",))
    stored = medallion.stored_arrivals(spark, path)
    want = {(r.statn_id, r.dt) for r in extract_arrivals(log).collect()}
    assert {(r.statn_id, r.dt) for r in stored.collect()} == want
    assert stored.count() == len(want)
    before = glob.glob(f"{path}/dt=2024-01-01/*.parquet")
    medallion.build_arrivals(log, path, extra=("direct_at",), dt_from="2024-01-02")
    assert glob.glob(f"{path}/dt=2024-01-01/*.parquet") == before
    assert {(r.statn_id, r.dt) for r in medallion.stored_arrivals(spark, path).collect()} == want


def _stored_rows(spark, path):
    return sorted(map(tuple, medallion.stored_arrivals(spark, path).collect()))


def test_closed_range_drops_a_false_arrival(spark, tmp_path):
    """A late stop at B on the 2nd makes the B of the 3rd no arrival."""
    path = str(tmp_path / "arrivals")
    rows = [record(1, "T", "A", "2024-01-01 08:00:00"), record(2, "T", "A", "2024-01-02 08:00:00"),
            record(3, "T", "B", "2024-01-03 08:00:00")]
    medallion.build_arrivals(_polled(spark, rows), path, extra=("direct_at",))
    log = _polled(spark, [*rows, record(4, "T", "B", "2024-01-02 09:00:00")])
    medallion.build_arrivals(log, path, extra=("direct_at",), dt_from="2024-01-02", dt_to="2024-01-02")
    assert [(r[2], r[-1]) for r in _stored_rows(spark, path)] == [("A", "2024-01-01"), ("B", "2024-01-02")]
    assert not os.path.exists(f"{path}/dt=2024-01-03")


def test_closed_range_restores_an_arrival(spark, tmp_path):
    """A late stop at B on the 2nd makes the A of the 3rd an arrival, on a date that had none."""
    path = str(tmp_path / "arrivals")
    rows = [record(1, "T", "A", "2024-01-01 08:00:00"), record(2, "T", "A", "2024-01-03 08:00:00"),
            record(3, "T", "C", "2024-01-05 08:00:00")]
    medallion.build_arrivals(_polled(spark, rows), path, extra=("direct_at",))
    log = _polled(spark, [*rows, record(4, "T", "B", "2024-01-02 09:00:00")])
    medallion.build_arrivals(log, path, extra=("direct_at",), dt_from="2024-01-02", dt_to="2024-01-02")
    assert [(r[2], r[-1]) for r in _stored_rows(spark, path)] == [
        ("A", "2024-01-01"), ("A", "2024-01-03"), ("B", "2024-01-02"), ("C", "2024-01-05"),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_ranges_equal_whole_runs(spark, tmp_path, seed):
    """Random logs, parts of which come late; ranges of all kinds leave what a whole run gives."""
    chance = random.Random(seed)
    rows = []
    for seq in range(160):
        when = f"2024-01-{chance.randint(1, 8):02} {chance.choice((0, 8, 23)):02}:{chance.randint(0, 3):02}:00"
        rows.append(record(seq, chance.choice(["T", "U", "V", "W", "X"]), chance.choice("AAB"), when))
    days = sorted(chance.sample(range(1, 9), 2))
    first, last = (f"2024-01-{d:02}" for d in days)
    late = [first <= json.loads(v)["recptn_dt"][:10] <= last and chance.random() < 0.6 for _, v in rows]
    path, whole = str(tmp_path / "arrivals"), str(tmp_path / "whole")
    early = _polled(spark, [r for r, is_late in zip(rows, late, strict=True) if not is_late])
    log = _polled(spark, rows)
    medallion.build_arrivals(log, whole, extra=("direct_at",))
    want = _stored_rows(spark, whole)
    medallion.build_arrivals(early, path, extra=("direct_at",))
    medallion.build_arrivals(log, path, extra=("direct_at",), dt_from=first, dt_to=last)
    assert _stored_rows(spark, path) == want
    assert incremental.snapshot_dates(spark, path) == sorted({last, max(want, key=lambda r: r[-1])[-1]})
    medallion.build_arrivals(early, path, extra=("direct_at",))
    medallion.build_arrivals(log, path, extra=("direct_at",), dt_to=last)
    assert _stored_rows(spark, path) == want
    medallion.build_arrivals(log, path, extra=("direct_at",), dt_from=first)
    assert _stored_rows(spark, path) == want


def test_dates_that_were_never_built_stay_absent(spark, tmp_path):
    path = str(tmp_path / "arrivals")
    log = _polled(spark, [record(n, "T", "ABC"[n], f"2024-01-0{n + 1} 08:00:00") for n in range(3)])
    for day in ("2024-01-01", "2024-01-02"):
        medallion.build_arrivals(log, path, extra=("direct_at",), dt_from=day, dt_to=day)
    assert [r[2] for r in _stored_rows(spark, path)] == ["A", "B"]


def test_a_failing_range_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "arrivals")
    rows = [record(1, "T", "A", "2024-01-01 08:00:00"), record(2, "T", "B", "2024-01-02 08:00:00")]
    medallion.build_arrivals(_polled(spark, rows), path, extra=("direct_at",))
    want = _stored_rows(spark, path)
    broken = _polled(spark, rows).withColumn("direct_at", F.raise_error(F.lit("unreadable")))
    with pytest.raises(Exception, match="unreadable"):
        medallion.build_arrivals(broken, path, extra=("direct_at",), dt_from="2024-01-02")
    assert _stored_rows(spark, path) == want


def test_same_second_return_is_one_key(spark, tmp_path):
    when = "2024-01-01 08:00:00"
    log = bronze_log(raw(spark, [record(i, "T", s, when) for i, s in enumerate("ABA")]))
    found = extract_arrivals(log)
    assert found.count() == 3
    tables.write_arrivals(found, str(tmp_path / "a"))
    stored = tables.read_arrivals(spark, str(tmp_path / "a"), found.schema)
    assert {(r.statn_id, r.seq) for r in stored.collect()} == {("A", 2), ("B", 1)}


def _file_counts(path):
    return {d: len(glob.glob(f"{path}/{d}/**/*.parquet", recursive=True)) for d in os.listdir(path) if d.startswith("dt=")}


def test_a_batch_writes_one_file_a_date(spark, tmp_path):
    rows = [record(n, f"T{n}", "A", f"2024-01-0{n % 3 + 1} 08:00:00") for n in range(60)]
    log, current = str(tmp_path / "log"), str(tmp_path / "current")
    batch = bronze_log(raw(spark, rows).repartition(8))
    bronze.write_position_log(batch, 0, log)
    bronze.upsert_current(batch, current)
    assert set(_file_counts(log).values()) == set(_file_counts(current).values()) == {1}


def test_compacted_log_has_one_file_a_date(spark, tmp_path):
    path, target = str(tmp_path / "log"), str(tmp_path / "compacted")
    for batch in range(5):
        rows = [record(10 * batch + n, "T", "AB"[n % 2], f"2024-01-0{n % 2 + 1} 08:00:{n:02}") for n in range(6)]
        bronze.write_position_log(bronze_log(raw(spark, rows)), batch, path)
    assert set(_file_counts(path).values()) == {5}
    bronze.compact_log(spark, path, target, spark.createDataFrame([("2024-01-01",)], "dt STRING"))
    assert _file_counts(target) == {"dt=2024-01-01": 1}
    main(["compact-log", "--source", path, "--target", target + "-all"])
    assert set(_file_counts(target + "-all").values()) == {1}

    def content(at):
        return sorted((r.seq, r.raw_json, r.dt) for r in bronze.read_position_log(spark, at).collect())

    assert content(target + "-all") == content(path)
    assert content(target) == [r for r in content(path) if r[2] == "2024-01-01"]


def test_a_failing_refresh_leaves_the_mart(spark, tmp_path):
    name, at = "gold_switch.mart", str(tmp_path / "mart")
    first = tables.save_mart(spark.createDataFrame([(1, "a")], "n INT, t STRING"), name, at)
    assert [tuple(r) for r in first.collect()] == [(1, "a")]
    broken = spark.createDataFrame([(2, "b")], "n INT, t STRING").withColumn("t", F.raise_error(F.lit("no mart")).cast("string"))
    with pytest.raises(Exception, match="no mart"):
        tables.save_mart(broken, name, at)
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "a")]
    # A mart made from itself, twice: two versions stay.
    for _ in range(3):
        tables.save_mart(spark.table(name).withColumn("n", F.col("n") + 1), name, at)
    assert [tuple(r) for r in spark.table(name).collect()] == [(4, "a")]
    assert len([d for d in os.listdir(at) if d.startswith("v-") and glob.glob(f"{at}/{d}/*.parquet")]) == 2
    wider = tables.save_mart(spark.createDataFrame([(5, "a", 1.0)], "n INT, t STRING, x DOUBLE"), name, at)
    assert [tuple(r) for r in wider.collect()] == [(5, "a", 1.0)]


@pytest.mark.parametrize("seed", range(2))
def test_parts_by_date_add_up_to_the_marts(spark, tmp_path, seed):
    """Late rows in some dates; arrivals, headway counts and freshness parts are refreshed for these alone."""
    chance = random.Random(seed)
    rows = []
    for seq in range(300):
        when = f"2024-01-{chance.randint(1, 6):02} {chance.choice((0, 8, 23)):02}:{chance.randint(0, 59):02}:{chance.randint(0, 59):02}"
        rows.append(record(seq, chance.choice("TUVWX"), chance.choice("ABC"), chance.choice([when] * 12 + ["bad-time", ""])))
    late = [json.loads(v)["recptn_dt"][:10] in ("2024-01-03", "2024-01-04", "bad-time") and chance.random() < 0.5 for _, v in rows]
    early, log = _polled(spark, [r for r, is_late in zip(rows, late, strict=True) if not is_late]), _polled(spark, rows)
    paths = {name: str(tmp_path / name) for name in ("arrivals", "counts", "parts")}
    cutoff = 43_200
    medallion.build_arrivals(early, paths["arrivals"], extra=("direct_at",))
    marts.build_headway_counts(medallion.stored_arrivals(spark, paths["arrivals"]), paths["counts"], cutoff)
    marts.build_freshness_parts(early, paths["parts"])
    dates = medallion.build_arrivals(log, paths["arrivals"], extra=("direct_at",), dt_from="2024-01-03", dt_to="2024-01-04")
    assert set(dates) >= {"2024-01-03", "2024-01-04"}
    arrivals = medallion.stored_arrivals(spark, paths["arrivals"])
    marts.build_headway_counts(arrivals, paths["counts"], cutoff, dates=dates)
    marts.build_freshness_parts(log, paths["parts"], dates=["2024-01-03", "2024-01-04"])

    def values(df):
        return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)

    counts = marts.stored_headway_counts(spark, paths["counts"])
    assert values(headways.mart_of_counts(counts)) == values(headways.headway_mart(extract_arrivals(log), cutoff))
    parts, whole = marts.stored_freshness_parts(spark, paths["parts"]), freshness.freshness_mart(log)

    def minutes(df):  # the two logs are stamped at different times
        return values(df.drop("ingest_lag_avg_sec"))

    assert minutes(freshness.mart_of_parts(parts)) == minutes(whole)
    days = marts.freshness_days(parts)
    assert values(freshness.coverage_of_days(days)) == values(freshness.coverage(whole))
    assert values(freshness.gaps_of_days(days)) == values(freshness.gap_summary(whole))
    by_extra = headways.mart_of_counts(headways.headway_counts(arrivals, cutoff, ("direct_at",)), extra_keys=("direct_at",))
    assert values(by_extra) == values(headways.headway_mart(arrivals, cutoff, extra_keys=("direct_at",)))


def test_current_state_of_many_versions(spark, tmp_path):
    """Versions within a batch and across batches and runs, equal ones included, against a plain loop."""
    chance, path, want = random.Random(7), str(tmp_path / "current"), {}
    for batch in range(4):
        rows = [record(chance.randrange(400), chance.choice("TUV"), chance.choice("AB"), f"2024-01-0{chance.randint(1, 3)} 08:00:00",
                       lstcar_at=str(chance.random())) for _ in range(40)]
        rows += rows[:3]  # delivered twice
        log = bronze_log(raw(spark, rows), F.lit(f"2024-02-0{batch + 1} 00:00:00").cast("timestamp"))
        for run in ("first", "again") if batch == 2 else ("first",):
            bronze.upsert_current(log, path, batch, run)
        for seq, text in rows:
            key = json.loads(text)["event_id"]
            if key not in want or (seq, batch) >= want[key][:2]:
                equal = want[key][2] if key in want and want[key][:2] == (seq, batch) else set()
                want[key] = (seq, batch, equal | {text})
    got = bronze.read_current(spark, path).collect()
    assert len(got) == len(want) == len({r.event_id for r in got})
    assert all(r.seq == want[r.event_id][0] and r.raw_json in want[r.event_id][2] for r in got)
    bronze.compact_current(spark, path, str(tmp_path / "compacted"))
    compacted = bronze.read_current(spark, str(tmp_path / "compacted")).collect()
    assert sorted(map(str, compacted)) == sorted(map(str, got))


def test_marts_are_replaced(spark, tmp_path):
    log = bronze_log(raw(spark, DAY1 + DAY2))
    for _run in range(2):
        mart, cover, gaps = medallion.build_freshness_mart(log, "gold_test.freshness")
    # Two of the four timed records share a minute.
    assert mart.count() == 3 and cover.first().total_records == 4 and gaps.count() == 1
    mart, ranking = medallion.build_headway_mart(extract_arrivals(log), "gold_test.headway")
    assert mart.columns[0] == "line" and ranking.columns[-1] == "over_1p5x_ratio"
    listed = tables.list_tables(spark, "gold_test").filter("NOT isTemporary")
    assert {r.tableName for r in listed.collect()} == {"freshness", "headway"}
    assert "gold_test" in {r[0] for r in tables.list_namespaces(spark).collect()}
    assert tables.scan_count(spark, "gold_test.freshness").first().rows == 3


def test_timetable_bytes_and_round_trip(spark, tmp_path):
    row = tuple(f'{name} "1",é한' if name == "station_nm" else "" for name in TIMETABLE_COLUMNS)
    df = spark.createDataFrame([row], list(TIMETABLE_COLUMNS))
    path = str(tmp_path / "timetable")
    write_timetable(df.coalesce(1), path)
    (part,) = glob.glob(f"{path}/*.csv")
    assert open(part, "rb").read().startswith(b"\xef\xbb\xbfline,station_cd,")
    assert read_timetable(spark, path).collect() == df.collect()


def test_timetable_columns_are_found_by_name(spark, tmp_path):
    row = tuple(f"v-{name}" for name in TIMETABLE_COLUMNS)
    df = spark.createDataFrame([row], list(TIMETABLE_COLUMNS))
    df.select(*reversed(df.columns)).write.csv(str(tmp_path / "t"), header=True)
    assert read_timetable(spark, str(tmp_path / "t")).collect() == df.collect()


def test_heartbeat_shows_every_line(spark):
    mart = spark.createDataFrame([("a", 1, 5), ("b", 1, 6), ("3", 2, 7)], "line STRING, minute_ts INT, records BIGINT")
    got = {tuple(sorted(r.asDict().items())) for r in heartbeat(mart).collect()}
    assert got == {(("3", None), ("a", 5), ("b", 6), ("minute_ts", 1)), (("3", 7), ("a", None), ("b", None), ("minute_ts", 2))}


def test_export(spark, tmp_path):
    spark.range(10).withColumn("raw_json", F.lit("{}")).createOrReplaceTempView("export_me")
    report = tables.export_tables(
        spark, {"good": "export_me", "bad": "no_such"}, str(tmp_path), single_file=True
    )
    good, bad = report.orderBy(F.desc("name")).collect()
    assert (good.rows, good.error) == (10, None)
    assert bad.rows is None and "no_such" in bad.error
    (part,) = glob.glob(f"{tmp_path}/good/*.csv")
    assert open(part).read().splitlines()[0] == "id"


def test_jobs(spark, tmp_path):
    """The whole chain through the command line."""
    paths = {n: str(tmp_path / n) for n in ("in", "log", "cur", "chk", "arr", "csv")}
    polls = [
        record(i, f"T{i % 2}", "AB"[i // 2 % 2], f"2024-01-01 08:{i:02}:00", direct_at="0")
        for i in range(40)
    ]
    _land(spark, paths["in"], polls)
    main(["bronze", "--format", "parquet", "--path", paths["in"], "--schema", RAW,
          "--option", "maxFilesPerTrigger=1", "--log", paths["log"], "--current", paths["cur"],
          "--checkpoint", paths["chk"], "--drain"])
    main(["arrivals", "--log", paths["log"], "--out", paths["arr"]])
    main(["backfill", "--raw", paths["in"], "--log", paths["log"] + "2", "--current", paths["cur"] + "2"])
    main(["compact", "--source", paths["log"], "--target", paths["cur"] + "3"])
    states = [bronze.read_current(spark, paths["cur"] + n).select("event_id", "seq").collect() for n in ("", "2", "3")]
    assert sorted(states[0]) == sorted(states[1]) == sorted(states[2])
    planned = [tuple({"station_nm": "nA", "week_tag": "1", "inout_tag": "1", "arrive_time": "08:00:00"}.get(n, "")
                     for n in TIMETABLE_COLUMNS)]
    write_timetable(spark.createDataFrame(planned, list(TIMETABLE_COLUMNS)), paths["csv"] + "-t")
    main(["delay", "--arrivals", paths["arr"], "--timetable", paths["csv"] + "-t",
          "--namespace", "gold_delay", "--late-sec", "180"])
    summed = spark.table("gold_delay.delay_by_station").first()
    assert summed.arrivals == spark.table("gold_delay.arrival_delay").count() > 0
    payload = json.dumps({"realtimePositionList": [{"trainNo": "7", "statnId": "A", "recptnDt": "2024-01-01 08:00:00"}]})
    spark.createDataFrame([("2호선", payload)], "line STRING, payload STRING").write.parquet(paths["in"] + "-api")
    main(["payloads", "--payloads", paths["in"] + "-api", "--out", paths["in"] + "-keyed"])
    (keyed,) = spark.read.parquet(paths["in"] + "-keyed").collect()
    assert keyed.key == "7" and json.loads(keyed.value)["event_id"] == "7-A--2024-01-01"
    main(["headway-mart", "--arrivals", paths["arr"], "--table", "gold_jobs.headway"])
    main(["freshness-mart", "--log", paths["log"], "--table", "gold_jobs.freshness"])
    main(["export", "--out", paths["csv"], "h=gold_jobs.headway", "f=gold_jobs.freshness"])
    assert spark.table("gold_jobs.headway").agg(F.sum("headway_samples")).first()[0] > 0
    assert spark.table("gold_jobs.freshness").count() == 40
    assert len(spark.read.csv(paths["csv"] + "/f", header=True).collect()) == 40
